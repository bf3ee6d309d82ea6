"""N-gram Jaccard join by parity sketches.

A document's set holds its distinct word n-grams. Equal sets are one class, by
a 128-bit fingerprint; only class representatives (smallest id) are compared.
Similarity of at least num/den bounds the symmetric difference of two sets by
their sizes. In a band of sizes each set is therefore XOR-hashed, n-gram by
n-gram, into more sketch blocks than the band's bound on differences: whatever
differs between two similar sets can touch only that many blocks, so some
blocks agree, and a join on (band, block, content) finds the pair. A second
sketch of single parity bits, at least two for each n-gram, travels with each
class: the Hamming distance of two such sketches bounds the difference from
below and sorts out candidates. What is left is verified on the sets.

Buckets never give all their pairs: first each member is held against the
bucket's smallest id only; components follow; only buckets that still hold
several components are compared again, in chunks of bounded size and across
components. They give the closest pairs that would join up all components which
open pairs could join, fewer than there are members. Members that are then still
in open pairs meet once more, with their whole sets: those pairs are verified
where they meet, and only links that join components leave the task.

Blocks without content say nothing, so a slack of blocks is added: two similar
sets agree on more blocks than the slack. If one of the sets leaves no more
void than that, some agreeing block has content. Sets that leave more void are
dealt out anew with other blocks, where the same holds; a set that does so
``TURNS`` times is joined on combinations of its void blocks.

Cases: null text is empty; an empty set links with nothing and is its own
component; a text with fewer words than n is one n-gram; repeated rows and
equal ids fall in one class by their sets; a row without id takes part and
gets its component's smallest id; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm import graph, hashing
from snapmart.llm.common import release, stored, texts
from snapmart.llm.workers import lean

TURNS = 8
CHUNK = 1024  # members of a large bucket compared at a time
MEMBERS = 1 << 20  # n-grams of the whole sets that are compared at a time
REFUSED = 1 << 18  # pairs found not similar that a task remembers
FEW = 64  # sets of a key that are told with it
GROWTH = 1.5  # width of a band of sizes
U = np.uint64


def shingle_sets(data: np.ndarray, off: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each row."""
    words, at = hashing.word_hashes(data, off)
    gram = words.copy()
    for k in range(1, n):
        gram[:-k] = gram[:-k] * U(0x9E3779B97F4A7C15) + words[k:]
    gram = hashing.mix(gram)
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if hi - lo >= n:
            yield np.unique(gram[lo:hi - n + 1])
        elif hi > lo:  # shorter than one n-gram: the whole sequence
            h = words[lo:lo + 1]
            for k in range(lo + 1, hi):
                h = h * U(0x9E3779B97F4A7C15) + words[k:k + 1]
            yield hashing.mix(h + U(hi - lo))
        else:
            yield words[:0]


def most_different(total: int, num: int, den: int) -> int:
    """Bound on the symmetric difference of two sets with ``total`` members in
    all whose intersection is at least num/den of their union."""
    return total * (den - num) // (den + num)


@lru_cache(maxsize=None)
def layout(lo: int, hi: int, num: int, den: int) -> tuple[int, int]:
    """(blocks, slack) of the band of sizes from lo to hi - 1. The slack is meant
    to exceed the blocks that the smallest set in the band leaves void, without
    adding more than a part of the blocks that the differences need."""
    apart, least, slack = most_different(2 * (hi - 1), num, den), lo * num / den, 2
    for _ in range(64):
        blocks = apart + 1 + slack
        void = blocks * math.exp(-least / blocks)
        need = int(void + 4 * math.sqrt(void)) + 2
        if need <= slack:
            break
        slack = min(need, 2 + (apart + 1) // 4)
    return apart + 1 + slack, slack


@lru_cache(maxsize=None)
def bands(size: int, num: int, den: int) -> tuple[tuple[int, int, int], ...]:
    """(band, blocks, slack) of the bands that a set of this size is in: its
    own, and the next one if a similar set can lie there. Sets so small that
    no two different ones are similar are in none."""
    lo, k = 1, 0
    while most_different(2 * lo, num, den) < 1:
        lo += 1
    found = []
    while lo * num <= size * den:  # a similar set has at most size * den / num members
        hi = max(lo + 1, int(lo * GROWTH))
        if size < hi:
            found.append((k, *layout(lo, hi, num, den)))
        lo, k = hi, k + 1
    return tuple(found)


def block_xor(h: np.ndarray, blocks: int, turn: int) -> np.ndarray:
    """Per block of the ``turn``-th dealing: the XOR of its members' hashes."""
    dealt = hashing.mix(h + U(turn)) if turn else h
    block = (dealt >> U(20)) % U(blocks)
    order = np.argsort(block, kind="stable")
    block, h = block[order].astype(np.int64), h[order]
    first = np.flatnonzero(np.diff(block, prepend=-1))
    wide = np.zeros(blocks, np.uint64)
    if len(h):
        wide[block[first]] = np.bitwise_xor.reduceat(h, first)
    return wide


def block_keys(h: np.ndarray, band: int, blocks: int, slack: int) -> np.ndarray:
    """What to join on: one value for each block with content. A set that leaves
    more blocks void than the slack is dealt out anew, up to TURNS times, and
    the last time has a value for each combination of slack + 1 void blocks."""
    keys = []
    for turn in range(TURNS):
        seed = hashing.mix(np.array([band * TURNS + turn + 1], np.uint64))[0]
        wide = block_xor(h, blocks, turn)
        full = np.flatnonzero(wide)
        keys.append(hashing.mix(wide[full] + hashing.mix(full.astype(np.uint64) + seed)))
        void = np.flatnonzero(wide == 0)
        if len(void) <= slack:
            return np.concatenate(keys)
    for some in combinations(void.tolist(), slack + 1):
        acc = np.full(1, ~seed)
        for v in some:
            acc = hashing.mix(acc + U(v))
        keys.append(acc)
    return np.concatenate(keys)


def parity(h: np.ndarray) -> np.ndarray:
    """A sketch of 64-bit words: every member flips one bit. A power of two in
    length, so a longer sketch folds by XOR into the shorter one's length."""
    words = 4
    while words * 32 < len(h):
        words *= 2
    bits = np.bincount((h & U(words * 64 - 1)).astype(np.int64), minlength=words * 64) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


NO_ID = (1 << 63) - 1  # stands for a missing id; larger than any other


def fingerprint(h: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    if not len(h):
        return 0, 0
    return (int(np.bitwise_xor.reduce(hashing.mix(h)).view(np.int64)),
            int(np.add.reduce(hashing.mix(h ^ U(0xA5A5A5A55A5A5A5A))).view(np.int64)))


def _each(batches: Iterator[pa.RecordBatch], n: int):
    """(ids, sets) of a slice of rows at a time."""
    for b in batches:
        for lo, hi, data, off in hashing.slices(b.column(1)):
            yield b.column(0).slice(lo, hi - lo), list(shingle_sets(data, off, n))


def _prints(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for ids, sets in _each(batches, n):
        fp = [fingerprint(h) for h in sets]
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([len(h) for h in sets], pa.int32()), pa.array([f[0] for f in fp], pa.int64()),
             pa.array([f[1] for f in fp], pa.int64()), pa.array([parity(h).tobytes() for h in sets], pa.binary())],
            names=["doc_id", "n", "fp1", "fp2", "bits"])


def _keys(batches: Iterator[pa.RecordBatch], n: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    for _, sets in _each(batches, n):
        keys, fps = [], []
        for h in sets:
            mine = [block_keys(h, *band) for band in bands(len(h), num, den)]
            keys += mine
            fps += [fingerprint(h)] * sum(map(len, mine)) if mine else []
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys).view(np.int64) if keys else [], pa.int64()),
             pa.array([f[0] for f in fps], pa.int64()), pa.array([f[1] for f in fps], pa.int64())],
            names=["key", "fp1", "fp2"])


PACKED = 1 << 19
RANGE = 1 << 19  # members of sets, each with about a key, for a range of keys
PAIR = np.dtype([("key", "<i8"), ("fp", "<i8")])


def few_of_keys(pairs: np.ndarray, few: int) -> np.ndarray:
    """Sorted and distinct, and of each key only the ``few`` smallest fingerprints.
    The few of several parts' few are the few of the whole."""
    pairs = pairs[np.lexsort((pairs["fp"], pairs["key"]))]
    if len(pairs):
        pairs = pairs[np.append(True, (pairs["key"][1:] != pairs["key"][:-1]) | (pairs["fp"][1:] != pairs["fp"][:-1]))]
    first, many = _spread(pairs)
    return pairs[np.arange(len(pairs)) - np.repeat(first, many) < few]


def _spread(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key of sorted pairs begins, and how many pairs it has."""
    first = np.flatnonzero(np.append(True, pairs["key"][1:] != pairs["key"][:-1])) if len(pairs) else np.zeros(0, int)
    return first, np.diff(np.append(first, len(pairs)))


def ends_of_keys(pairs: np.ndarray) -> np.ndarray:
    """As many of each key's fingerprints as tell whether sets share it."""
    return few_of_keys(pairs, 2)


def _dealt_keys(batches: Iterator[pa.RecordBatch], n: int, num: int, den: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Keys and fingerprints packed by ranges of keys, one row for each range
    and PACKED keys; a key has at most FEW + 1 entries in it."""
    # sorted keys fall into ``parts`` ranges of equal width
    edges = np.array([(1 << 64) * k // parts - (1 << 63) for k in range(1, parts)], np.int64)

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        pairs = few_of_keys(np.concatenate(held), FEW + 1)
        rows = np.split(pairs, np.searchsorted(pairs["key"], edges))
        return pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int32()), pa.array([r.tobytes() for r in rows], pa.binary())],
                                          names=["part", "pairs"]).filter(pa.array([len(r) > 0 for r in rows], pa.bool_()))

    held, size = [np.zeros(0, PAIR)], 0
    for k in _keys(batches, n, num, den):
        pairs = np.empty(k.num_rows, PAIR)
        pairs["key"], pairs["fp"] = k.column(0).to_numpy(), k.column(1).to_numpy()
        held.append(pairs)
        size += len(pairs)
        if size >= PACKED:
            yield packed(held)
            held, size = [np.zeros(0, PAIR)], 0
    yield packed(held)


def _range(batches: Iterator[pa.RecordBatch], few: int) -> np.ndarray:
    """The few of each key of a range, from all its rows."""
    held = [np.zeros(0, PAIR)]
    for b in batches:
        held += [np.frombuffer(p.as_buffer(), PAIR) for p in b.column(1)]
        if sum(map(len, held[1:])) > 4 * len(held[0]) + (1 << 20):
            held = [few_of_keys(np.concatenate(held), few)]
    return few_of_keys(np.concatenate(held), few)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys that sets with different fingerprints have, from all rows of a range."""
    pairs = _range(batches, 2)
    yield pa.RecordBatch.from_arrays([pa.array(pairs["key"][1:][pairs["key"][1:] == pairs["key"][:-1]])], names=["key"])


def _sharing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Such keys with the fingerprints of all their sets, or once with none if
    they have more than FEW."""
    pairs = _range(batches, FEW + 1)
    first, many = _spread(pairs)
    of = np.repeat(many, many)
    common = of > FEW
    stay = (of > 1) & ~common
    stay[first[many > FEW]] = True
    yield pa.RecordBatch.from_arrays([pa.array(pairs["key"][stay]), pa.array(pairs["fp"][stay], mask=common[stay])], names=["key", "fp"])


def key_ranges(members: int, least: int) -> int:
    """Ranges of keys for sets of so many members in all: more members, more
    ranges, so that a task never holds much more than RANGE entries at a time."""
    return max(1, least, -(-members // RANGE))


def shared_keys(src: DataFrame, n: int, num: int, den: int, members: int) -> DataFrame:
    """Keys of more than one set, each with the fingerprints (fp) of its sets; a
    key of more than FEW sets comes once, with a null. A key that very many sets
    have is at most FEW + 1 entries from each batch of rows, and a task packs its
    keys before the shuffle, so tens of millions of keys need neither hash tables
    nor rows."""
    parts = key_ranges(members, int(src.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = src.mapInArrow(lean(partial(_dealt_keys, n=n, num=num, den=den, parts=parts)), "part int, pairs binary")
    return dealt.repartition(parts, "part").mapInArrow(lean(_sharing), "key long, fp long")


def members_of_keys(src: DataFrame, classes: DataFrame, n: int, num: int, den: int, members: int) -> DataFrame:
    """The rows (key, id) of shared keys. Texts give all their keys again only
    where some keys have more than FEW sets, and then for these keys alone."""
    shared = stored(shared_keys(src, n, num, den, members), "jaccard-buckets")
    release(src.sparkSession)
    node = F.col("node").alias("id")
    member = shared.filter(F.col("fp").isNotNull()).join(classes.select(F.col("fp1").alias("fp"), "node"), "fp").select("key", node)
    common = stored(shared.filter(F.col("fp").isNull()).select("key").repartition("key"), "jaccard-common")
    if not common.isEmpty():
        keyed = src.mapInArrow(lean(partial(_keys, n=n, num=num, den=den)), "key long, fp1 long, fp2 long")
        member = member.union(keyed.join(common, "key").distinct().join(classes.select("fp1", "fp2", "node"), ["fp1", "fp2"]).select("key", node))
    member = stored(member, "jaccard-members")
    release(src.sparkSession)
    return member


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for ids, sets in _each(batches, n):
        fp = [fingerprint(h) for h in sets]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in fp], pa.int64()), pa.array([f[1] for f in fp], pa.int64()),
             pa.array([h.tobytes() for h in sets], pa.binary())], names=["fp1", "fp2", "members"])


def open_pair(n: int, bits: np.ndarray, m: int, other: np.ndarray, num: int, den: int) -> bool:
    """Whether sizes and sketches leave a pair open."""
    if min(n, m) * den < max(n, m) * num:
        return False
    words = min(len(bits), len(other))
    far = int(np.bitwise_count(folded(bits, words) ^ folded(other, words)).sum())
    return far <= most_different(n + m, num, den)


def _open(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Keep the rows (a, b, n and bits of a, n and bits of b) that are not ruled out."""
    for b in batches:
        keep = [open_pair(n, np.frombuffer(x, np.uint64), m, np.frombuffer(y, np.uint64), num, den)
                for n, x, m, y in zip(*(b.column(i).to_pylist() for i in range(2, 6)), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def similar(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    same = int(np.count_nonzero(both[1:] == both[:-1]))
    return den * same >= num * (len(x) + len(y) - same)


def _verified(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Keep the rows (a, b, members of a, members of b) that are similar."""
    for b in batches:
        keep = [similar(*(np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y)), num, den)
                for x, y in zip(b.column(2), b.column(3), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def sets_of(nodes: DataFrame, src: DataFrame, classes: DataFrame, n: int) -> DataFrame:
    """The whole sets (node, members) of some nodes."""
    wanted = stored(classes.join(nodes.select("node").distinct(), "node").select("node", "class_id", "fp1", "fp2"), "jaccard-wanted")
    sets = (src.join(wanted.select(F.col("class_id").alias("doc_id")), "doc_id", "left_semi")
            .mapInArrow(lean(partial(_sets, n=n)), "fp1 long, fp2 long, members binary").join(wanted, ["fp1", "fp2"]))
    sets = stored(sets.select("node", "members"), "jaccard-members-of")
    release(src.sparkSession)
    return sets


def links(pairs: DataFrame, src: DataFrame, classes: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The similar ones among candidate pairs (a, b) of nodes, by their whole sets."""
    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")), src, classes, n)
    x = sets.select(F.col("node").alias("a"), F.col("members").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("members").alias("y"))
    full = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return stored(full.mapInArrow(lean(partial(_verified, num=num, den=den)), "a long, b long").distinct(), "jaccard-links")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each (key, lo, hi) of sorted rows."""
    group, at = [], None
    for batch in batches:
        for r in batch.to_pylist():
            if (now := (r["key"], r["lo"], r["hi"])) != at:
                if group:
                    yield group
                group, at = [], now
            group.append(r)
    if group:
        yield group


def open_across(group: list[dict], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of a group (places in it, two columns) in different
    components that sizes and sketches leave open, the closest first; and the
    rows' components."""
    left = [i for i, r in enumerate(group) if r["own"] == r["lo"]]
    right = left if group[0]["lo"] == group[0]["hi"] else [i for i, r in enumerate(group) if r["own"] == r["hi"]]
    bits = [np.frombuffer(r["bits"], np.uint64) for r in group]
    by_length: dict[int, list[int]] = {}
    for i in right:
        by_length.setdefault(len(bits[i]), []).append(i)
    ids, comp, size = (np.array([r[c] for r in group]) for c in ("id", "comp", "n"))
    tables = [(words, np.array(at), np.stack([bits[i] for i in at])) for words, at in by_length.items()]
    found, gaps = [np.zeros((0, 2), np.int32)], [np.zeros(0)]
    for i in left:
        for words, at, table in tables:
            most = (size[at] + size[i]) * (den - num) // (den + num)
            near = np.flatnonzero((comp[at] != comp[i]) & (np.minimum(size[at], size[i]) * den >= np.maximum(size[at], size[i]) * num)
                                  & ((ids[at] > ids[i]) | (left is not right)))
            if len(near):
                least = min(words, len(bits[i]))
                far = np.bitwise_count(folded(table[near], least) ^ folded(bits[i], least)).sum(axis=1)
                stay = far <= most[near]
                near, far = near[stay], far[stay]
                found.append(np.column_stack([np.full(len(near), i), at[near]]).astype(np.int32))
                gaps.append(far / (most[near] + 1))
    pairs = np.concatenate(found)
    return pairs[np.argsort(np.concatenate(gaps), kind="stable")], comp


def forest(pairs: np.ndarray, comp: np.ndarray) -> np.ndarray:
    """Those of the pairs, the first ones preferred, that join up the components
    which they all together join: fewer than there are components."""
    top, comp = np.unique(comp, return_inverse=True)
    top, taken = np.arange(len(top)), [np.zeros((0, 2), pairs.dtype)]
    while True:
        ends = top[comp[pairs]]
        apart = ends[:, 0] != ends[:, 1]
        pairs, ends = pairs[apart], ends[apart]
        if not len(pairs):
            return np.concatenate(taken)
        first = np.unique(np.unique(ends, return_index=True)[1] // 2)  # of each component; by a total order, so without cycles
        taken.append(pairs[first])
        up = top.copy()
        for a, b in ends[first].tolist():
            a, b = _root(up, a), _root(up, b)
            up[max(a, b)] = min(a, b)
        top = np.array([_root(up, c) for c in top.tolist()])


def _root(up, node):
    while up[node] != node:
        node = up[node]
    return node


def _likeliest(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b), fewer than the components of each group: the closest open
    ones that would join up what any open ones could."""
    for group in _groups(batches):
        ids = np.array([r["id"] for r in group])
        pairs = ids[forest(*open_across(group, num, den))]
        yield pa.RecordBatch.from_arrays([pa.array(pairs.min(axis=1)), pa.array(pairs.max(axis=1))], names=["a", "b"])


def _undecided(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """The rows (key, id) of each group that are in an open pair."""
    for group in _groups(batches):
        rows = np.unique(open_across(group, num, den)[0]).tolist()
        yield pa.RecordBatch.from_arrays([pa.array([group[i][c] for i in rows], pa.int64()) for c in ("key", "id")], names=["key", "id"])


def _joined(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Similar pairs (a, b) across components in each group of rows with whole
    sets: fewer than there are components, and all that any pairs would join."""
    refused: set[tuple[int, int]] = set()  # pairs meet under several keys
    for group in _groups(batches):
        sets = [np.frombuffer(r["members"], np.uint64) for r in group]
        for r, h in zip(group, sets, strict=True):
            r["n"], r["bits"] = len(h), parity(h).tobytes()
        pairs, comp = open_across(group, num, den)
        top, comp = np.unique(comp, return_inverse=True)
        up, comp, taken = list(range(len(top))), comp.tolist(), []
        for i, j in pairs.tolist():
            a, b = _root(up, comp[i]), _root(up, comp[j])
            pair = min(group[i]["id"], group[j]["id"]), max(group[i]["id"], group[j]["id"])
            if a == b or pair in refused:
                continue
            if similar(sets[i], sets[j], num, den):
                up[max(a, b)] = min(a, b)
                taken.append(pair)
            else:
                refused.add(pair)
        if len(refused) > REFUSED:
            refused.clear()
        yield pa.RecordBatch.from_pydict({c: pa.array([p[k] for p in taken], pa.int64()) for k, c in enumerate("ab")})


def mixed_buckets(member: DataFrame, label: DataFrame) -> DataFrame:
    """The rows (key, id, comp) of buckets that hold several components. Two
    rows alone have been held against each other."""
    placed = stored(member.join(label.select(F.col("node").alias("id"), "label"), "id", "left").select(
        "key", "id", F.coalesce("label", "id").alias("comp")), "jaccard-placed")
    mixed = stored(placed.groupBy("key").agg(F.count("*").alias("many"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
                   .filter((F.col("many") > 2) & (F.col("c0") != F.col("c1"))).select("key"), "jaccard-mixed")
    return stored(placed.join(mixed, "key"), "jaccard-at")


def grouped(rows: DataFrame, load: Column, most: int) -> DataFrame:
    """Rows of buckets in groups (key, lo, hi) that hold every pair of a
    bucket's rows: a bucket's chunks, by two, of about ``most`` of ``load``."""
    chunks = stored(rows.groupBy("key").agg(F.ceil(F.sum(load) / most).cast("int").alias("chunks")), "jaccard-chunks")
    return (rows.join(chunks, "key").withColumn("own", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
            .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .withColumns({"lo": F.least("own", "with"), "hi": F.greatest("own", "with")}).drop("chunks", "with"))


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "id")


def across(member: DataFrame, label: DataFrame, classes: DataFrame, num: int, den: int, work: Callable, schema: str) -> DataFrame:
    """What ``work`` tells of members of buckets (key, id) that hold several
    components, in groups with sketches."""
    dealt = grouped(mixed_buckets(member, label), F.lit(1), CHUNK).join(classes.select(F.col("node").alias("id"), "n", "bits"), "id")
    told = _sorted(dealt.select("key", "lo", "hi", "own", "id", "comp", "n", "bits")).mapInArrow(partial(work, num=num, den=den), schema)
    return stored(told.distinct(), "jaccard-across")


def settled(left: DataFrame, label: DataFrame, src: DataFrame, classes: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Similar pairs across components among rows (key, id), compared by their
    whole sets within groups, so that however many pairs the sketches leave
    open, only links that join components are ever written."""
    sets = sets_of(left.select(F.col("id").alias("node")), src, classes, n).withColumnRenamed("node", "id")
    sized = stored(left.join(classes.select(F.col("node").alias("id"), "n"), "id").join(
        label.select(F.col("node").alias("id"), "label"), "id", "left").select(
        "key", "id", "n", F.coalesce("label", "id").alias("comp")), "jaccard-undecided")
    rows = grouped(sized, F.col("n"), MEMBERS).join(sets, "id").select("key", "lo", "hi", "own", "id", "comp", "members")
    return stored(_sorted(rows).mapInArrow(lean(partial(_joined, num=num, den=den)), "a long, b long").distinct(), "jaccard-settled")


def join(docs: DataFrame, n: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """One row per input row: doc_id, n_shingles, class_id (smallest id with the
    same set), component_id (smallest id reachable by links). Two documents
    link when den * intersection >= num * union, a similarity of 0.8 or more:
    below, sets would need more blocks than they have members to fill them."""
    if 5 * num < 4 * den or num > den:
        raise ValueError("the similarity must be from 0.8 to 1")
    spark = docs.sparkSession
    src = texts(docs).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), "text")
    every = stored(src.mapInArrow(lean(partial(_prints, n=n)), "doc_id long, n int, fp1 long, fp2 long, bits binary"), "jaccard-sets")
    classes = stored(every.filter("n > 0").groupBy("fp1", "fp2").agg(
        F.min("doc_id").alias("class_id"), F.first("n").alias("n"), F.first("bits").alias("bits"))
        .withColumn("node", F.monotonically_increasing_id()), "jaccard-classes")
    members = every.agg(F.sum("n").alias("n")).first()["n"] or 0
    member = members_of_keys(src, classes, n, num, den, members)
    hub = stored(member.groupBy("key").agg(F.min("id").alias("hub")), "jaccard-hubs")
    star = member.join(hub, "key").filter("id != hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    x = classes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bits").alias("xa"))
    y = classes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("xb"))
    open_star = stored(star.join(x, "a").join(y, "b").select("a", "b", "na", "xa", "nb", "xb")
                       .mapInArrow(partial(_open, num=num, den=den), "a long, b long"), "jaccard-star")
    near = links(open_star, src, classes, n, num, den)
    label = graph.components(near, "jaccard-first")
    more = across(member, label, classes, num, den, _likeliest, "a long, b long")
    release(spark)
    if not more.isEmpty():
        near = near.union(links(more, src, classes, n, num, den))
        label = graph.components(near, "jaccard-second")
        left = across(member, label, classes, num, den, _undecided, "key long, id long")
        release(spark)
        if not left.isEmpty():
            last = settled(left, label, src, classes, n, num, den)
            if not last.isEmpty():
                label = graph.components(near.union(last), "jaccard-all")
    joined = stored(label.join(classes.select("node", "class_id", "fp1", "fp2"), "node")
                    .select("label", "class_id", "fp1", "fp2"), "jaccard-joined")
    lowest = joined.groupBy("label").agg(F.min("class_id").alias("component_id"))
    linked = classes.select("fp1", "fp2", "class_id").join(
        joined.join(lowest, "label").select("fp1", "fp2", "component_id"), ["fp1", "fp2"], "left")
    told = every.select("doc_id", "n", "fp1", "fp2").join(stored(linked, "jaccard-linked"), ["fp1", "fp2"], "left")
    known = lambda c: F.when(c != NO_ID, c)
    return told.select(known(F.col("doc_id")).alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
                       known(F.coalesce("class_id", "doc_id")).alias("class_id"),
                       known(F.coalesce("component_id", "class_id", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """One row of each component stays, the one with the smallest id, columns
    as they were. A row without id cannot be told apart and stays."""
    found = join(docs, n, num, den)
    stay = stored(found.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct(), "jaccard-stay")
    one = docs.join(stay, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return one.union(docs.filter(F.col("doc_id").isNull())).select(*docs.columns)
