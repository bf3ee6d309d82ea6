import pytest
from hypothesis import given
from hypothesis import strategies as st

from snapmart.operators import quality, rule_text


def test_both_rule_sets_parse_to_the_lists():
    assert rule_text.parse(rule_text.CHANNEL_RULES_TEXT) == quality.CHANNEL_RULES
    assert rule_text.parse(rule_text.VIDEO_RULES_TEXT) == quality.VIDEO_RULES


columns = st.text(st.characters(blacklist_characters="\n", blacklist_categories=("Cs",)))
rules = st.lists(st.one_of(
    st.builds(quality.ColumnCount, value=st.integers(0, 10**6)),
    st.builds(quality.Completeness, column=columns, value=st.sampled_from([0.0, 0.25, 0.5, 1.0])),
    st.builds(quality.DistinctValuesCount, column=columns, value=st.integers(0, 10**6)),
    st.builds(quality.IsComplete, column=columns), st.builds(quality.IsPrimaryKey, column=columns)))


@given(rules)
def test_round_trip(some):
    assert rule_text.parse(rule_text.render(some)) == some


def test_free_white_space_comments_and_last_comma():
    text = '# checks\nRules=[IsComplete"a" ,# why\n\tCompleteness "b\\"c\\\\" = 0.5,\n]'
    assert rule_text.parse(text) == [quality.IsComplete("a"), quality.Completeness('b"c\\', 0.5)]
    assert rule_text.parse("Rules = []") == []


@pytest.mark.parametrize("text,line,column", [
    ("", 1, 1), ("Rule = []", 1, 1), ("Rules []", 1, 7), ("Rules = [", 1, 10), ("Rules = [\n  IsUnique \"a\"]", 2, 3),
    ("Rules = [ColumnCount = x]", 1, 24), ("Rules = [ColumnCount = 1.5]", 1, 24), ("Rules = [\nIsComplete a]", 2, 12),
    ('Rules = [IsComplete "a]', 1, 21), ('Rules = [IsComplete "a" IsComplete "b"]', 1, 25), ("Rules = [,]", 1, 10),
    ("Rules = []\n x", 2, 2), ("Rules = [ColumnCount = 1; ]", 1, 25), ('Rules = [Completeness "a"]', 1, 26)])
def test_errors_name_the_place(text, line, column):
    with pytest.raises(rule_text.RuleTextError) as e:
        rule_text.parse(text)
    assert (e.value.line, e.value.column) == (line, column), str(e.value)
