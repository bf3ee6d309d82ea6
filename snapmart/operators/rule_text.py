"""Quality rules written as text.

    Rules = [
        ColumnCount = 10,
        Completeness "channel_id" = 1,
        IsPrimaryKey "channel_id"
    ]

``parse`` gives the ``Rule`` objects of ``quality`` in the order of the text,
``render`` the text of a rule list. A column name is quoted, with ``\\"`` and
``\\\\`` for a quote and a backslash in it; white space is free, ``#`` starts a
comment, a comma may follow the last rule. Text that cannot be read raises
``RuleTextError`` with the line and column of the first place that is wrong.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from snapmart.operators.quality import ColumnCount, Completeness, DistinctValuesCount, IsComplete, IsPrimaryKey, Rule

#: name -> (class, takes a column, type of its value or None)
KINDS = {
    "ColumnCount": (ColumnCount, False, int),
    "Completeness": (Completeness, True, float),
    "DistinctValuesCount": (DistinctValuesCount, True, int),
    "IsComplete": (IsComplete, True, None),
    "IsPrimaryKey": (IsPrimaryKey, True, None),
}

_TOKEN = re.compile(r"""(?P<skip>\s+|\#[^\n]*)|(?P<name>[A-Za-z]+)|(?P<text>"(?:[^"\\\n]|\\["\\])*")"""
                    r"""|(?P<number>\d+(?:\.\d+)?)|(?P<sign>[=\[\],])""")


class RuleTextError(ValueError):
    def __init__(self, text: str, at: int, what: str):
        self.line = text.count("\n", 0, at) + 1
        self.column = at - (text.rfind("\n", 0, at) + 1) + 1
        super().__init__(f"line {self.line}, column {self.column}: {what}")


@dataclass(frozen=True)
class _Token:
    kind: str
    text: str
    at: int


def _tokens(text: str) -> list[_Token]:
    out, at = [], 0
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            what = "a column name that is not closed" if text[at] == '"' else f"unexpected {text[at]!r}"
            raise RuleTextError(text, at, what)
        if m.lastgroup != "skip":
            out.append(_Token(m.lastgroup, m[0], at))
        at = m.end()
    return [*out, _Token("end", "", len(text))]


def parse(text: str) -> list[Rule]:
    tokens = iter(_tokens(text))
    now = next(tokens)

    def fail(what: str):
        raise RuleTextError(text, now.at, f"expected {what}, found {now.text or 'the end'}")

    def take(kind: str, what: str, exactly: str | None = None) -> str:
        nonlocal now
        if now.kind != kind or exactly not in (None, now.text):
            fail(what)
        taken, now = now.text, next(tokens, now)
        return taken

    def rule() -> Rule:
        if now.kind != "name" or now.text not in KINDS:
            fail("one of " + ", ".join(KINDS))
        kind, has_column, value = KINDS[take("name", "a rule")]
        given = {}
        if has_column:
            given["column"] = re.sub(r"\\(.)", r"\1", take("text", "a column name in quotes")[1:-1])
        if value:
            take("sign", "=", "=")
            if now.kind == "number" and value is int and "." in now.text:
                fail("a whole number")
            given["value"] = value(take("number", "a number"))
        return kind(**given)

    take("name", "Rules", "Rules")
    take("sign", "=", "=")
    take("sign", "[", "[")
    rules: list[Rule] = []
    while now.text != "]":
        rules.append(rule())
        if now.text != "]":
            take("sign", ", or ]", ",")
    take("sign", "]", "]")
    if now.kind != "end":
        fail("nothing more")
    return rules


def render(rules: list[Rule]) -> str:
    def said(rule: Rule) -> str:
        _, has_column, value = KINDS[rule.kind]
        column = (rule.column or "").replace("\\", "\\\\").replace('"', '\\"')
        number = f"{rule.value!r}" if value else ""
        return rule.kind + (f' "{column}"' if has_column else "") + (f" = {number}" if value else "")
    return "Rules = [\n" + ",\n".join("    " + said(r) for r in rules) + "\n]\n"


# The two rule sets of the original quality jobs, as text.
CHANNEL_RULES_TEXT = """
Rules = [
    ColumnCount = 10,
    Completeness "channel_id" = 1,
    DistinctValuesCount "channel_id" = 5,
    IsComplete "published_date",
    IsPrimaryKey "channel_id"
]
"""

VIDEO_RULES_TEXT = """
Rules = [
    ColumnCount = 20,
    Completeness "channel_id" = 1,
    Completeness "video_id" = 1,
    DistinctValuesCount "channel_id" = 5,
    IsComplete "published_date",
    IsPrimaryKey "video_id"
]
"""
