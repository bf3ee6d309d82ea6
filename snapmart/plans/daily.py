"""The daily run: raw listings -> curated -> dimensions, facts, quality.

``run_day`` chains the operators for one run date. Every step writes a table
(day partition, dimension version or outcome partition) under ``root``, so a
later step reads stored data instead of recomputing the chain, and a rerun
of the same day replaces that day's output instead of adding to it.
"""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from snapmart import schemas
from snapmart.operators import clean, dims, facts, quality, rule_text
from snapmart.sources import read_csv, read_day, write_day
from snapmart.sources.tables import stored_versions, version_folders


TABLES = ("curated_channel", "curated_video", "channel_dim", "video_dim",
          "channel_fact", "video_fact", "dq_channel", "dq_video")


@dataclass(frozen=True)
class Layout:
    """Table locations under one root folder (one attribute per table)."""
    root: str

    def path(self, table: str) -> str:
        if table not in TABLES:
            raise KeyError(f"unknown table {table!r}")
        return os.path.join(self.root, table)


for _t in TABLES:
    setattr(Layout, _t, property(lambda self, _t=_t: self.path(_t)))


def clean_day(spark: SparkSession, raw_channel_path: str, raw_video_path: str,
              out: Layout, as_of: dt.date, allow=clean.CHANNEL_ALLOW_LIST) -> dict:
    """Cleaning job: curated channel and video days. Returns the null profile
    of the video listing and its corrupt-row count, gathered during the
    curated write (the raw file is parsed once)."""
    ch = read_csv(spark, raw_channel_path, schemas.RAW_CHANNEL)
    write_day(clean.curate_channel(ch, as_of), out.curated_channel, "updated_date", as_of)
    vid = read_csv(spark, raw_video_path, schemas.RAW_VIDEO)
    obs = Observation("video_profile")
    write_day(clean.curate_video_profiled(vid, "channel_id", allow, as_of, obs),
              out.curated_video, "updated_date", as_of)
    return obs.get


def consume_day(spark: SparkSession, out: Layout, as_of: dt.date,
                on_duplicate: str = "error") -> None:
    """Consumption job: merge the day into the dimensions, write the facts."""
    vid = read_day(spark, out.curated_video, schemas.CURATED_VIDEO, as_of)
    ch = read_day(spark, out.curated_channel, schemas.CURATED_CHANNEL, as_of)
    dims.load_dimension(spark, out.video_dim, vid, schemas.VIDEO_DIM, ["video_id"],
                        schemas.VIDEO_DIM_UPDATE, schemas.VIDEO_DIM_COLUMNS, as_of, on_duplicate)
    dims.load_dimension(spark, out.channel_dim, ch, schemas.CHANNEL_DIM, ["channel_id"],
                        schemas.CHANNEL_DIM_UPDATE, schemas.CHANNEL_DIM_COLUMNS, as_of, on_duplicate)
    facts.write_snapshot_day(facts.channel_snapshot(ch, as_of), out.channel_fact, as_of)
    facts.write_snapshot_day(facts.video_snapshot(vid, as_of), out.video_fact, as_of)


def check_day(spark: SparkSession, out: Layout, as_of: dt.date,
              channel_rules: str | list = quality.CHANNEL_RULES, video_rules: str | list = quality.VIDEO_RULES) -> None:
    """Quality jobs: both rule sets (``Rule`` objects or rule text) on the run day's curated rows."""
    for table, schema, rules, dest in (
            (out.curated_channel, schemas.CURATED_CHANNEL, channel_rules, out.dq_channel),
            (out.curated_video, schemas.CURATED_VIDEO, video_rules, out.dq_video)):
        rules = rule_text.parse(rules) if isinstance(rules, str) else rules
        outcomes = quality.evaluate(read_day(spark, table, schema, as_of), rules, as_of)
        quality.write_outcomes(outcomes, dest)


def stored_reports(spark: SparkSession, root: str, as_of: dt.date,
                   months: int = 12, n: int = 10) -> dict[str, DataFrame]:
    """The report queries over the stored tables of ``root``: newest committed
    dimension versions and newest snapshot days (picked from folder names)."""
    from snapmart.operators import reports
    from snapmart.sources import read_latest_version
    out = Layout(root)
    vdim = read_latest_version(spark, out.video_dim, schemas.VIDEO_DIM)
    cdim = read_latest_version(spark, out.channel_dim, schemas.CHANNEL_DIM)
    vfact = facts.read_latest_snapshot(spark, out.video_fact, schemas.VIDEO_FACT)
    cfact = facts.read_latest_snapshot(spark, out.channel_fact, schemas.CHANNEL_FACT)
    recent = reports.recent_uploads(vdim, as_of, months)
    return {
        "top_viewed": reports.top_viewed(vdim, vfact, n),
        "engagement_ratio": reports.engagement_ratio(vdim, vfact),
        "channel_video_counts": reports.channel_video_counts(cdim, cfact),
        "channel_subscriber_counts": reports.channel_subscriber_counts(cdim, cfact),
        "uploads_per_channel": reports.uploads_per_channel(recent),
        "uploads_per_quarter": reports.uploads_per_quarter(recent),
        "uploads_per_month": reports.uploads_per_month(recent),
    }


def run_day(spark: SparkSession, raw_channel_path: str, raw_video_path: str, root: str,
            as_of: dt.date, allow=clean.CHANNEL_ALLOW_LIST) -> dict:
    out = Layout(root)
    profile = clean_day(spark, raw_channel_path, raw_video_path, out, as_of, allow)
    consume_day(spark, out, as_of)
    check_day(spark, out, as_of)
    return profile


def newest_versions(spark: SparkSession, out: Layout) -> list[str]:
    """Folders of the dimensions' newest committed versions."""
    found = ((p, stored_versions(spark, p)) for p in (out.video_dim, out.channel_dim))
    return [f for p, v in found if v for f in version_folders(spark, p, v[-1])]


def main(argv=None) -> None:
    """``python -m snapmart.plans.daily --raw-channel P --raw-video P --out P
    --as-of YYYY-MM-DD [--allow id,id,...]``"""
    import argparse

    from snapmart.session import build_session, size_shuffle_partitions
    ap = argparse.ArgumentParser(description="run one day of the pipeline")
    ap.add_argument("--raw-channel", required=True)
    ap.add_argument("--raw-video", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--as-of", required=True, type=dt.date.fromisoformat)
    ap.add_argument("--allow", default=",".join(clean.CHANNEL_ALLOW_LIST),
                    help="comma list of allowed channel ids")
    a = ap.parse_args(argv)
    spark = build_session()
    try:
        # the merges shuffle the whole stored dimensions besides the day's listings
        out = Layout(a.out)
        size_shuffle_partitions(spark, a.raw_channel, a.raw_video, *newest_versions(spark, out))
        profile = run_day(spark, a.raw_channel, a.raw_video, a.out, a.as_of, a.allow.split(","))
        print(profile)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
