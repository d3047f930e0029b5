from __future__ import annotations

import json
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from threadmill.operators import flagging
from threadmill.functions import jobspec as J, text as T, times
from threadmill.functions.fields import ColumnFields, JsonFields
from threadmill.functions.matching import (
    content_filter, matched_terms, phase2_keywords, phase2_regexes, word_pattern_of,
)
from threadmill.session import prepare


@pytest.fixture(scope="module", autouse=True)
def _ready(spark):
    prepare(spark)


def values(spark, column_of, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column_of(F.col("v"))).collect()]


def test_type_prefix(spark):
    ids = ["t3_abc", "t1_x", "t3_", "tx_y", "abc", "", None, "x3_abc", "t3abc"]
    assert values(spark, T.strip_type_prefix, ids) == [
        "abc", "x", "t3_", "y", "abc", None, None, "x3_abc", "t3abc"
    ]


def test_parent_comment(spark):
    assert values(spark, T.parent_comment_id, ["t1_a", "t3_p", "t1_", None, "zz"]) == [
        "a", None, None, None, None
    ]


def test_blanks_are_unicode(spark):
    assert values(spark, T.strip, ["\t a b \n", " x"]) == ["a b", "x"]
    assert values(spark, lambda v: T.canonical_subreddit(v, F.lit(" Back ")), [" PyThon ", "", None, " "]) == [
        "python", "back", "back", ""
    ]


def test_names(spark):
    assert values(spark, T.partition_name, [" Ab-c.d ", "--", ""]) == ["ab_c_d", "_", "_"]
    assert values(spark, T.target_key, ["r/Harbour", "/r/harbour", " HARBOUR", "r/r/x", "//x"]) == [
        "harbour", "harbour", "harbour", "r/x", "x"
    ]


def test_epochs(spark):
    given_values = ["1600000000", "1600000000.9", "-1.9", "1e3", " 12 ", "12d", "nan", "inf", "x", "", None]
    assert values(spark, times.epoch_seconds, given_values) == [
        1600000000, 1600000000, -1, 1000, 12, None, None, None, None, None, None
    ]


def test_iso_text(spark):
    assert values(spark, times.iso_utc, [0, -1, 1735689599, 10**15, None], "bigint") == [
        "1970-01-01T00:00:00+00:00", "1969-12-31T23:59:59+00:00", "2024-12-31T23:59:59+00:00", None, None
    ]
    assert values(spark, times.minute_label, [61, None], "bigint") == ["1970-01-01 00:01", "?"]


def test_offsets_are_dropped(spark):
    texts = ["2024-01-02T03:04:05+02:00", "2024-01-02T03:04:05Z", "2024-01-02", "2024-01-02 03:04:05.5",
             "soon", "", None, "2024-13-01", "2024-01-02T03:04:05-0530"]
    got = values(spark, lambda v: times.iso_wall_clock(times.wall_clock(v)), texts)
    assert got == ["2024-01-02T03:04:05", "2024-01-02T03:04:05", "2024-01-02T00:00:00",
                   "2024-01-02T03:04:05.500000", None, None, None, None, "2024-01-02T03:04:05"]


def test_json_and_column_fields_agree(spark):
    df = spark.createDataFrame(
        [('{"score": 5.7}', None), ('{"score": "5.7"}', "5.7"), ('{"score": "42"}', "42"),
         ('{"score": true}', "x"), ('{"score": 1, "score": 2}', "2")], "raw string, score string"
    )
    json_side = [r[0] for r in df.select(JsonFields(F.try_parse_json("raw")).whole("score")).collect()]
    assert json_side == [5, None, 42, 1, 2]
    assert [r[0] for r in df.select(ColumnFields(df).whole("score")).collect()] == [None, None, 42, None, 2]


# --- clauses -----------------------------------------------------------------------------

# "river", one of "ferry" and "bridge", not "toll", and the phrase "far bank".
TRUTH = [
    ("The river ferry lands on the far bank at noon", True),
    ("A bridge over the RIVER leads to the Far Bank", True),
    ("The ferry lands on the far bank", False),
    ("The river has a far bank and no way across", False),
    ("River bridge to the far bank, toll due", False),
    ("River bridge to the far side, then the bank", False),
    ("Riverside ferry to the far bank", False),
    ("", False),
]


def test_clause_table(spark):
    got = values(spark, lambda v: content_filter(v, ["river"], ["ferry", "bridge"], ["toll"], "far bank"), [t for t, _ in TRUTH])
    assert got == [want for _, want in TRUTH]


def test_none_words_and_empty_text(spark):
    texts = ["tolls are high", "no toll today", "", "TOLL", "toll_gate", "tollé", "toll\u0301"]
    got = values(spark, lambda v: content_filter(v, none_words=["toll"]), texts)
    assert got == [True, False, False, False, True, True, False]


def test_no_clauses_mean_no_filter():
    assert content_filter(None, [], [], [], None) is None


def _python_word(word: str, text: str) -> bool:
    return re.search(rf"(?<!\w){re.escape(word)}(?!\w)", text, re.IGNORECASE) is not None


WORDS = ["the", "c++", "\\E", "K", "s", "i", "é", "a.b", "x y", "(", "$1", "ß", "ſet", "12"]
TEXTS = ["The end", "other", "c++ rules", "abc++d", "a\\Eb \\E", "5 K", "ſ", "É", "aéb é", "a.b", "axb",
         "x y", "(x)", "$1", "ß", "ſET set", "İ i", "ı", "012 12", "_the_ the_", "étHe", "thé"]


def test_whole_words_match_like_python(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    for word in WORDS:
        got = {r.t: r.hit for r in df.select("t", content_filter(F.col("t"), all_words=[word]).alias("hit")).collect()}
        assert got == {t: _python_word(word, t) for t in TEXTS}, word


def test_word_pattern_of_column_is_the_same(spark):
    df = spark.createDataFrame([(w, t) for w in WORDS for t in TEXTS], "w string, t string")
    rows = df.select("w", "t", F.rlike("t", word_pattern_of(F.col("w"))).alias("hit")).collect()
    assert all(r.hit == _python_word(r.w, r.t) for r in rows)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("aAsSiIkK é_1-.", max_size=12), min_size=5, max_size=30))
def test_random_texts_match_like_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in set(texts)], "t string")
    for word in ("as", "sik", "a-1", "é"):
        hit = content_filter(F.col("t"), any_words=[word])
        assert all(r.hit == (bool(r.t) and _python_word(word, r.t)) for r in df.select("t", hit.alias("hit")).collect())


def test_terms_are_sorted_and_distinct(spark):
    words = phase2_keywords(["Ran", "ran", " ", "mal"])
    patterns = phase2_regexes([r"(?P<a>m)al(?P=a)?", r"\bware\b", "  "])
    got = values(spark, lambda v: matched_terms(v, words, patterns), ["RANsom Malware", "x", None, ""])
    assert got == [[r"(?P<a>m)al(?P=a)?", "mal", "ran"], [], [], []]


PATTERNS = [r"a.b", r"end$", r"^x", r"\bé\w", r"[A-C]{2}", r"(?P<q>['\"]).*(?P=q)", r"\Z", r"\d+ \s", "straße|ı", r"a\Z"]
LINES = ["a\rb", "a\nb", "A\u2028B", "the END\n", "x", "y\nx", "Éa", "éé", "abC", "'it' \"", "12 \t", "STRASSE", "I", "ba"]


def test_user_patterns_find_what_python_finds(spark):
    df = spark.createDataFrame([(t,) for t in LINES], "t string")
    for pattern, java in phase2_regexes(PATTERNS).items():
        got = {r.t: r.hit for r in df.select("t", F.rlike("t", F.lit(java)).alias("hit")).collect()}
        assert got == {t: re.search(pattern, t, re.IGNORECASE) is not None for t in LINES}, pattern


def test_bad_pattern_fails_before_any_job():
    with pytest.raises(re.error):
        phase2_regexes(["("])


# --- job payload fields ------------------------------------------------------------------


def _targets(spark, payloads):
    df = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(payloads)], "i int, t string")
    df = df.withColumn("t", F.try_parse_json("t")).selectExpr("i", f"{J.present_items('t')} AS e")
    rows = df.selectExpr("i", f"array_distinct(array_compact({J.target_names('e')})) AS n").orderBy("i").collect()
    return [r.n for r in rows]


def test_every_form_of_a_target_names_it(spark):
    """Bare, with a prefix, or inside an address: the name in lower case, if it has 2 to 21 word characters."""
    wraps = ["{}", "r/{}", "/r/{}", "r/{}/", "  {}\t", "www.forum.test/r/{}", "http://forum.test/r/{}/top?t=all", "https://old.forum.test/r/{}/x/y#z"]
    names = ["Qt", "x" * 21, "_a_", "C_64", "MixedCase9"]
    assert _targets(spark, [w.format(n) for n in names for w in wraps]) == [[n.lower()] for n in names for _ in wraps]
    wrong = ["q", "x" * 22, "a-b", "é1", "forum.test/top", ""]
    assert _targets(spark, wrong) == [[]] * len(wrong)


def test_lists_of_targets(spark):
    lists = ["qt, C_64 ,,r/Qt", ["Qt", None, " r/c_64 ", "QT"], ["/r/b2", "not one", "b2"], [], None]
    assert _targets(spark, lists) == [["qt", "c_64"], ["qt", "c_64"], ["b2"], [], []]


def test_words_phrases_and_truth(spark):
    def read(expression, inputs):
        df = spark.createDataFrame(list(enumerate(inputs)), "i int, t string").withColumn("v", F.try_parse_json("t"))
        return [r[0] for r in df.orderBy("i").selectExpr(expression).collect()]

    assert read(J.words("v"), ['"blue  red blue"', '["green grey", 7]', "null", '""']) == [
        ["blue", "red"], ["green", "grey", "7"], [], []
    ]
    assert read(J.phrase("v"), ['"  a \\t b "', '"  "', "null"]) == ["a b", None, None]
    assert read(J.truth("v", True), ["true", "0", '" YES "', '"off"', "null", "1.5"]) == [
        True, False, True, False, True, True
    ]


@pytest.mark.parametrize("pattern", ["(a)?b(?(1)c|d)", "(?P<n>a)(?P=n)(?(n)b)"])
def test_patterns_the_jvm_cannot_run_are_refused_at_once(spark, pattern):
    with pytest.raises(ValueError, match="cannot be used"):
        phase2_regexes([pattern])


@pytest.mark.parametrize("pattern", ["[[a]", "[a&&b]", "x[]y]", "[^]a]b", r"a\\Z", r"b\Z", r"[\]a]c", "[a-z&]1"])
def test_classes_mean_the_same_on_both_sides(spark, pattern):
    texts = ["[", "a", "&", "b", "]", "x]", "xy", "qb", "]b", "a\\Z", "a\\", "ab", "b", "]c", "ac", "&1", "z1", ""]
    java = phase2_regexes([pattern])[pattern]
    got = values(spark, lambda v: F.rlike(v, F.lit(java)), texts)
    assert got == [re.search(pattern, t, re.IGNORECASE) is not None for t in texts]


def test_keyword_table_looks_up_tokens_and_lowercases_a_text_once(spark):
    texts = ["Alpha beta", "alphabet\n\tsoup", "beta  gamma Open Water x", "open\nwater", "", None, "Öl und ÉTÉ", "alpha " * 3000 + "zeta"]
    rows = spark.createDataFrame([("s", f"c{i}", t) for i, t in enumerate(texts)], "subreddit string, id string, body string")
    keywords = ["ALPHA", "a", "eta", "open water", "n\nw", " x", "été", "ÖL", "  ", "", "zeta", "missing", "no such", "ta g", "ta  g"]
    table = spark.createDataFrame([(k,) for k in keywords], "word string")
    found = flagging.find_terms_of(rows, table, "word")
    got = {r["id"]: r["terms"] for r in found.collect()}
    low = [(t or "").lower() for t in texts]
    wanted = [k.lower() for k in keywords if k.strip()]
    assert got == {f"c{i}": sorted({k for k in wanted if k in t}, key=lambda k: k.encode()) for i, t in enumerate(low)}
    # Lowercased for every keyword it was met with, a record of some hundred keywords took seconds.
    assert "contains(lower(" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
