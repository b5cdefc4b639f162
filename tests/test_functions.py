import random
import tracemalloc
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.util import PythonEvalType

from corpusloom.functions import display as D
from corpusloom.functions import quantiles, rates
from corpusloom.functions import text as T


def one(spark, column, **values):
    """A column's values over a one-row table of strings or numbers."""
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first()["x"]


def texts(spark, values, f):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string").select("i", f(F.col("t")).alias("x")).orderBy("i").collect()
    return [r["x"] for r in rows]


def test_script(spark):
    given = ["صباح الخير", "ابعت الـ link دلوقتي يا صاحبي", "only latin here", "   ", ""]
    assert texts(spark, given, T.looks_like_script) == [True, True, False, False, False]
    assert texts(spark, ["ab يا", " "], T.script_ratio) == [0.5, None]


def test_clean(spark):
    given = ["  'hello'  ", '"a"', "a \U0001f600 b", "a\u200bb\ufeff", "x \u00a0\t\n y", "\" 'a' \"", "\u2600"]
    assert texts(spark, given, T.clean) == ["hello", "a", "a b", "ab", "x y", "'a'", ""]


def test_white_space_is_pythons(spark):
    every = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    got = texts(spark, [f"a{c}b" for c in every], T.word_count)
    assert [c for c, n in zip(every, got, strict=True) if n == 2] == [c for c in every if c.isspace()]


def test_word_count(spark):
    assert texts(spark, ["", "  ", "a", " a  b\u3000c "], T.word_count) == [0, 0, 1, 3]


def test_hash_ignores_spaces_and_marks(spark):
    a, b, c, d = texts(spark, ["كتاب جديد", " كتاب   جديد ", "كِتاب جـديد", "كتاب جدير"], T.text_hash)
    assert a == b == c != d and len(a) == 12


def test_hash_composes_first(spark):
    composed = "caf\u00e9"
    a, b = texts(spark, [composed, unicodedata.normalize("NFD", composed)], T.text_hash)
    assert a == b


def test_light_form_keeps_letters(spark):
    assert texts(spark, ["جـمـيل", "أكل"], T.normalize_light) == ["جميل", "أكل"]


def test_comparison_form(spark):
    given = ["أحمد إلى آخر", "مدرسة", "على", "٣٤", "ما، هذا؟", "  HELLO   World  ", "كِتَاب", "a_b-c"]
    assert texts(spark, given, T.normalize_for_comparison) == ["احمد الي اخر", "مدرسه", "علي", "34", "ما هذا", "hello world", "كتاب", "a_b c"]


def _levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("r,h", [("a b c", "a b c"), ("a b c", "a x c"), ("a", "a b c d"), ("a b a b", "b a"), ("é ü", "e ü")])
def test_error_rates(spark, r, h):
    assert one(spark, rates.cer(F.col("r"), F.col("h")), r=r, h=h) == pytest.approx(_levenshtein(r, h) / len(r))
    assert one(spark, rates.wer(F.col("r"), F.col("h")), r=r, h=h) == pytest.approx(_levenshtein(r.split(), h.split()) / len(r.split()))


def test_error_rates_of_empty_texts(spark):
    assert one(spark, rates.cer(F.col("r"), F.col("h")), r="", h="x") is None
    assert one(spark, rates.wer(F.col("r"), F.col("h")), r="x", h="") is None


def test_word_distance_with_a_large_vocabulary(spark):
    r = [f"w{i}" for i in range(700)]
    h = r[:300] + ["new"] + r[301:690]
    assert one(spark, rates.word_distance(F.split("r", " "), F.split("h", " ")), r=" ".join(r), h=" ".join(h)) == _levenshtein(r, h)


def test_speaking_rate(spark):
    assert one(spark, rates.chars_per_second(F.col("t"), F.col("d")), t="ab c\td", d=2.0) == 2.5
    assert one(spark, rates.chars_per_second(F.col("t"), F.col("d")), t="ab", d=0.0) == pytest.approx(2e6)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 80])
def test_order_statistics(spark, n):
    xs = [((i * 37) % n) / 10 for i in range(n)]
    got = quantiles.order_statistics(spark.createDataFrame([("k", x) for x in [*xs, None]], "k string, x double"), ["k"], "x").first()
    s = sorted(xs)
    assert got["n"] == n and got["upper_median"] == s[n // 2] and got["p90"] == s[int(n * 0.9)]
    assert got["median"] == pytest.approx((s[(n - 1) // 2] + s[n // 2]) / 2)


def test_histogram(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 3, 4, 4)], "x double")
    assert {r["bin"]: r["n"] for r in quantiles.histogram(df, "x", 4).collect()} == {1: 1, 2: 1, 3: 1, 4: 3}
    same = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [(r["bin"], r["n"]) for r in quantiles.histogram(same, "x", 4).collect()] == [(1, 2)]


def test_display(spark):
    assert one(spark, D.number(F.col("x"), 2), x=0.345) == f"{0.345:.2f}"
    assert one(spark, D.number(F.col("x"), 1, "s"), x=1234.25) == f"{1234.25:.1f}s"
    assert one(spark, D.number(F.lit(None).cast("double"), 2), x=1) == "-"
    assert one(spark, D.shortened(F.col("t")), t="x" * 81) == "x" * 77 + "..."
    assert one(spark, D.flag_list(F.array().cast("array<string>")), x=1) == "none"
    assert one(spark, D.label(F.col("k"), {"a": "A"}), k="b") == "b"
    assert one(spark, D.slug(F.col("p"), F.col("v")), p="edge", v="a/b:c") == "edge-a_b_c"
    assert one(spark, D.dataset_relative(F.col("p")), p="x/y/z.wav") == "audio/z.wav"
    assert one(spark, D.posix(F.col("p")), p="a\\b") == "a/b"
    assert [one(spark, D.is_absolute(F.col("p")), p=p) for p in ("C:/x", "/x", "x/y")] == [True, True, False]


def test_word_distance_of_odd_lists(spark):
    lists = [[], ["a"], ["a", "", "a"], [None, "a"], ["", None], ["\u00e9", "e"], None, [f"w{i}" for i in range(60000)]]
    pairs = [(i, r, h) for i, (r, h) in enumerate((r, h) for r in lists for h in lists if len(r or ()) + len(h or ()) < 60010)]
    got = {r["i"]: r["d"] for r in spark.createDataFrame(pairs, "i int, r array<string>, h array<string>").select("i", rates.word_distance(F.col("r"), F.col("h")).alias("d")).collect()}
    assert got == {i: _levenshtein(r or [], h or []) for i, r, h in pairs}


def test_words_are_no_python_objects():
    # a batch for pandas becomes lists of strings before the function is called
    assert rates._as_characters.evalType == PythonEvalType.SQL_SCALAR_ARROW_UDF
    words = pa.array([[f"word{i % 997}_{j}" for j in range(85)] for i in range(2000)], pa.list_(pa.string()))
    tracemalloc.start()
    rates._as_characters.func(words, words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8e6


def test_texts_stay_out_of_python(spark):
    for f in (T.nfc, T.text_hash, T.normalize_for_comparison):
        df = spark.createDataFrame([("x",)], "t string").select(f(F.col("t")))
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_composition_is_that_of_unicodedata(spark):
    known = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    odd = [c for c in known if unicodedata.combining(c) or unicodedata.decomposition(c)]
    rng = random.Random(0)
    given = [*odd, *("".join(rng.choices(odd, k=6)) for _ in range(20000)), *(unicodedata.normalize("NFD", "".join(rng.choices(known, k=9))) for _ in range(5000)), "", None]
    assert texts(spark, given, T.nfc) == [None if t is None else unicodedata.normalize("NFC", t) for t in given]


def test_segments_lose_spaces_only(spark):
    # a segment's place in the list is not what its ends are stripped of
    lines = ["007", " 1 and 1", "2x2 ", "", "5"]
    assert one(spark, D.joined_segments(F.split("t", "\n")), t="\n".join(lines)) == "007 1 and 1 2x2  5"


@pytest.mark.parametrize("reply,expected", [('{"prompts": ["a", 3, 1.5]}', ["a", "3", "1.5"]), ('{"جمل": ["b"]}', ["b"]), ('{"prompts": [], "جمل": ["b"]}', ["b"]), ("no json", []), ('{"prompts": "x"}', []), ("{}", [])])
def test_reply(spark, reply, expected):
    assert one(spark, D.prompts_from_json(F.col("t")), t=reply) == expected


def test_rounding_to_even(spark):
    assert [one(spark, F.bround(F.lit(x)), x=1) for x in (12.5, 37.5)] == [12.0, 38.0]
    # on ties of the decimal form Spark and exact binary rounding may differ in the last place
    assert abs(one(spark, F.bround(F.lit(0.1235), 3), x=1) - round(0.1235, 3)) < 1.1e-3


def test_cer_pairs_whole_counts_letters_beyond_ascii(spark, monkeypatch):
    from corpusloom.plans import queries

    pairs = [(1, 0, "\u0643\u062a\u0627\u0628", "\u0628\u0627\u0628\u0627"), (2, 0, "caf\u00e9", "caf\u00e8")]
    monkeypatch.setattr(queries.roles, "pairs", lambda *_: spark.createDataFrame(pairs, "conv_id long, turn int, ref string, hyp string"))
    normal = {r["conv_id"]: r for r in spark.createDataFrame(pairs, "conv_id long, turn int, ref string, hyp string").select("conv_id", T.normalize_for_comparison(F.col("ref")).alias("ref"), T.normalize_for_comparison(F.col("hyp")).alias("hyp")).collect()}
    for r in queries.cer_pairs_whole(spark, "").collect():
        want = normal[r["conv_id"]]
        assert r["cer"] == pytest.approx(_levenshtein(want["ref"], want["hyp"]) / len(want["ref"])) and r["cer"] > 0
