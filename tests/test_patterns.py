import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidewater.contracts import Check, Column, Contract, validate
from tidewater.operators import patterns as pt
from tidewater.operators.synth import synthesize_contract

PATTERNS = ["abc", "[a-c]+", "a|bc|d*", "(ab){2,4}x?", r"\d{3}-\d{4}", r"[^a-z]{2}", "User_[1-9]", "Page_[1-9][0-9]", "(?i:ok)!", "a.c", r"\w+@\w+\.(com|org)",
            "^start", "end$", "^(a|b)$", "(?:x(y(z)?)?)?", r"a\.b", "[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", "é{2}", r"\s\S", "a{0}b"]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_drawn_strings_match(pattern):
    words = pt.language([pattern], [])
    got = words.draw(np.arange(300))
    assert all(re.match(f"(?:{pattern})", w, re.A) for w in got)
    assert got == words.draw(np.arange(300)) and (len(set(got)) > 1 or words.total == 1)
    affixes = [] if "^" in pattern[:1] or "$" in pattern else ["pre", "post"]
    assert all(re.search(pattern, w, re.A) for w in pt.language([], [pattern], *affixes).draw(np.arange(100)))


@settings(max_examples=120, deadline=None)
@given(st.recursive(st.sampled_from(["a", "b", "[ab]", "[^b]", "."]), lambda x: st.one_of(
    st.tuples(x, x).map("".join), st.tuples(x, x).map(lambda p: f"(?:{p[0]}|{p[1]})"), x.map(lambda p: f"(?:{p})*"), x.map(lambda p: f"(?:{p}){{1,2}}"),
    x.map(lambda p: f"(?:{p})?")), max_leaves=6))
def test_automata_accept_what_the_pattern_does(pattern):
    whole = pt.pattern_automaton(pattern, frozenset("abc"), False, False)
    for n in range(4):
        for text in map("".join, itertools.product("abc", repeat=n)):
            assert whole.accepts(text) == bool(re.fullmatch(pattern, text))


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab", max_size=3), st.text(alphabet="ab", max_size=3), st.lists(st.text(alphabet="ab", max_size=3), max_size=3))
def test_affixes_and_exclusions(prefix, suffix, out):
    abc = frozenset("abc")
    both = pt.product(pt.affixed(prefix, suffix, abc), pt.excluding(out, abc))
    for n in range(5):
        for text in map("".join, itertools.product("abc", repeat=n)):
            want = text.startswith(prefix) and text.endswith(suffix) and len(text) >= max(len(prefix), len(suffix)) and text not in out
            assert both.accepts(text) == want


@settings(max_examples=60, deadline=None)
@given(st.sampled_from(["[ab]{0,3}c?", "a*b*", "x|yz|[ab]c"]), st.integers(0, 2), st.integers(2, 4))
def test_numbers_enumerate_the_language(pattern, least, most):
    words = pt.Language(pt.pattern_automaton(pattern, frozenset("abcxyz"), False, False), least, most)
    listed = words.nth(np.arange(words.total))
    assert len(set(listed)) == words.total == sum(1 for n in range(least, most + 1) for t in map("".join, itertools.product("abcxyz", repeat=n))
                                                  if re.fullmatch(pattern, t))
    assert all(re.fullmatch(pattern, w) and least <= len(w) <= most for w in listed)


def test_numbers_of_large_languages_differ():
    words = pt.language(["[a-z]{30}"], [])
    assert words.total == 26**30
    far = np.array([0, 1, 2, 10**6, 2**61, 2**61 + 1, 2**62 - 1])
    assert len(set(words.nth(far))) == len(far)


@pytest.mark.parametrize("pattern", [r"(a)\1", "(?=a)b", "a^b", "a$b", "(?m:a)", "a{2000}"])
def test_what_is_not_regular_is_refused(pattern):
    with pytest.raises(pt.Unsupported):
        pt.language([pattern], [])


def test_contradictions_are_named():
    with pytest.raises(ValueError, match="no string"):
        pt.language(["a+$"], [], prefix="b")
    with pytest.raises(ValueError, match="no string"):
        pt.language(["[ab]$"], [], without=["a", "b"])
    assert pt.language(["a"], [], suffix="z").draw(np.arange(3))[0].endswith("z")  # the pattern isn't anchored at its end


WIDE = Contract(columns={
    "code": Column("str", [Check.str_matches(r"[A-Z]{2}-\d{2,4}$"), Check.notin(["AA-00", "ZZ-99"]), Check.str_length(5, 6)], unique=True),
    "mail": Column("str", [Check.str_contains(r"@(example|test)\.org$"), Check.str_startswith("u")]),
    "small": Column("str", [Check.str_matches("[ab]$"), Check.ne("a")]),
    "n": Column("int64", [Check.in_range(0, 9), Check.notin([0, 3, 4, 9, 77])]),
    "m": Column("int64", [Check.ge(0), Check.notin([0, 2])], unique=True),
    "x": Column("float64", [Check.in_range(0.0, 1.0), Check.notin([0.5])]),
    "at": Column("datetime64[ns]", [Check.in_range("2024-01-01 00:00:00", "2024-01-01 00:00:05"), Check.notin(["2024-01-01 00:00:02"])]),
    "yes": Column("bool", Check.notin([False])),
    "kind": Column("str", [Check.isin(["apple", "avocado", "bean", "ant"]), Check.str_startswith("a"), Check.notin(["ant"]), Check.unique_values_eq(["apple", "avocado"])]),
    "fixed": Column("int64", Check.eq(7)),
    "even": Column("int64", [Check.in_range(0, 20), Check.custom(lambda c: c % 2 == 0, "even")]),
}, checks=[Check.custom(lambda cols: cols.n <= cols.even, "ordered"), Check.custom(lambda cols: F.max(cols.n) > 0, "some", aggregate=True)])


def test_rows_pass_their_own_contract(spark):
    rows = synthesize_contract(spark, WIDE, n=400, seed=5, attempts=24).cache()
    failures = {(r["column"], r["check"]): r["failures"] for r in validate(WIDE, rows, "report").collect()}
    assert set(failures.values()) == {0} and len(failures) > 20, failures
    assert rows.count() == 400 and {r.n for r in rows.collect()} == {1, 2, 5, 6, 7, 8}
    assert {r.small for r in rows.collect()} == {"b"} and rows.select("mail").distinct().count() > 300
    again = synthesize_contract(spark, WIDE, ids=spark.range(400).repartition(7), seed=5, attempts=24)
    assert again.exceptAll(rows).count() == 0


def test_exhausted_choices_fail(spark):
    unique = Contract(columns={"a": Column("str", Check.str_matches("[ab]{2}$"), unique=True)})
    assert {r.a for r in synthesize_contract(spark, unique, n=4).collect()} == {"aa", "ab", "ba", "bb"}
    with pytest.raises(Exception, match="possible values"):
        synthesize_contract(spark, unique, n=5).collect()
    never = Contract(columns={"a": Column("int64", Check.custom(lambda c: c < 0, "negative"))})
    with pytest.raises(Exception, match="attempts"):
        synthesize_contract(spark, never, n=2).collect()
    for column in (Column("int64", [Check.in_range(1, 2), Check.notin([1, 2])]), Column("str", [Check.isin(["a"]), Check.ne("a")])):
        with pytest.raises(ValueError, match="no value"):
            synthesize_contract(spark, Contract(columns={"a": column}), n=2)


def test_rows_rejected_by_chance_are_drawn_on(spark):
    """A row in ten passes, so a dozen draws leave one row in four without any; ids repeat and may be null."""
    rare = Contract(columns={
        "code": Column("str", Check.str_matches(r"[A-Z]{2}\d{3}$"), unique=True),
        "mail": Column("str", [Check.str_matches(r"[a-z]{1,4}@x$")]),
        "at": Column("datetime64[ns]", Check.in_range("2024-01-01 00:00:00", "2024-01-01 00:00:05")),
        "n": Column("int64", [Check.in_range(0, 20), Check.notin([4])]),
    }, checks=[Check.custom(lambda cols: cols.n < 2, "small"), Check.custom(lambda cols: F.length(cols.mail) > 3, "long")])
    ids = spark.range(500).union(spark.range(5)).repartition(3)
    rows = synthesize_contract(spark, rare, ids=ids, seed=5).cache()
    assert rows.count() == 505 and rows.distinct().count() == 500
    assert rows.where("n >= 2 OR length(mail) <= 3 OR NOT mail RLIKE '^[a-z]{1,4}@x$' OR NOT code RLIKE '^[A-Z]{2}[0-9]{3}$'").count() == 0
    assert rows.select("mail").distinct().count() > 300
    again = synthesize_contract(spark, rare, ids=ids.coalesce(1), seed=5)
    assert again.exceptAll(rows).count() == 0
