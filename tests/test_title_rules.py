import random

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from reelmart.functions.titles import sample_title_rules, title_rules_from, title_series
from reelmart.operators import title_rules
from reelmart.operators.title_rules import ANCHOR, anchored, bloom, clauses, clauses_met, label_by_rules, phrase_runs
from reelmart.sources.star_adapter import Star

RULES = "ordinal int, label string, contains array<string>, lacks array<string>, equals string"


def table(spark, found):
    return spark.createDataFrame([(c.ordinal, c.label, list(c.contains), list(c.lacks) or None, c.equals) for c in found], RULES)


def generated(spark, texts, n=578):
    """Rules of every shape: one phrase, several, alternatives, exclusions, equality, short and long phrases."""
    random_, out = random.Random(3), []
    for ordinal in range(n):
        for _ in range(1 + (ordinal % 5 == 0)):
            cut = []
            for _ in range(1 + ordinal % 3):
                text = random_.choice(texts).lower()
                at = random_.randrange(len(text))
                cut.append(text[at : at + random_.choice([2, 5, ANCHOR, 12, 20])])
            lacks = [random_.choice(["the", "part", "e", "#shorts"])] if ordinal % 4 == 0 else None
            equals = random_.choice(texts).lower() if ordinal % 50 == 49 else None
            out.append((ordinal, f"rule {ordinal}", None if equals else cut, lacks, equals))
    return spark.createDataFrame(random_.sample(out, len(out)), RULES)


@pytest.fixture(scope="module")
def titles(spark):
    star = Star(spark, SMALL)
    short = star.table("documents").select(F.substring("text", 1, 80).alias("title"))
    return star.input("metadata").select(F.col("VIDEO_TITLE").alias("title")).union(short)


def test_equals_the_chain_on_the_sample_rules(spark, titles):
    chain = titles.select("title", title_series("title", sample_title_rules()).alias("label"))
    assert rows(label_by_rules(titles, "title", table(spark, sample_title_rules()), "label"), "*") == rows(chain, "*")


def test_equals_the_chain_on_578_rules(spark, titles):
    texts = sorted({r.title for r in titles.where("title is not null").collect() if len(r.title) > 25})
    rules = generated(spark, texts)
    chain = titles.select("title", title_series("title", title_rules_from(rules)).alias("label"))
    got = rows(label_by_rules(titles, "title", rules, "label"), "*")
    assert got == rows(chain, "*") and len({label for _, label in got}) > 20


def test_odd_phrases_and_texts(spark):
    texts = spark.createDataFrame([(t,) for t in [None, "", "a", "AB", "xaby", "日本語の長いタイトル", "\U0001f600 ok", "100%_x\\y"]], "t string")
    found = [(1, "empty phrase", ["", "zz"], None, None), (2, "ab", ["ab"], ["y"], None), (3, "long", ["長いタイトル"], None, None), (4, "sign", ["%_x\\"], None, None), (5, "smile", ["\U0001f600"], None, None), (6, "is a", None, None, "a"), (7, "nothing", None, None, ""), (8, "anything", [""], None, None)]
    rules = spark.createDataFrame(found, RULES)
    chain = texts.select("t", title_series("t", title_rules_from(rules)).alias("label"))
    assert rows(label_by_rules(texts, "t", rules, "label"), "*") == rows(chain, "*")
    assert rows(label_by_rules(texts, "t", rules.limit(0), "label"), "label") == [("other",)] * 8
    with pytest.raises(Exception, match="tests nothing"):
        label_by_rules(texts, "t", spark.createDataFrame([(1, "x", None, ["a"], None)], RULES), "label").collect()


def test_alternatives_that_hash_alike_are_all_kept(spark):
    texts = spark.createDataFrame([(t,) for t in ["a", "b", "ab", "xa", "xb", "ba x", ""]], "t string")
    alternatives = [[(["a", "b"], None, None), (["a"], ["b"], None), (["a"], None, "b")], [(["b"], None, None), (None, None, "b")], [(["a"], [], None), (["a"], None, None)]]
    for found in [*alternatives, sum(alternatives, [])]:
        table = spark.createDataFrame([(1, "first", *c) for c in found] + [(2, "second", ["x"], None, None)], RULES)
        assert clauses(table).count() == len({(*map(tuple, (has or (), lacks or ())), equals) for has, lacks, equals in found}) + 1
        chain = texts.select("t", title_series("t", title_rules_from(table)).alias("label"))
        assert rows(label_by_rules(texts, "t", table, "label"), "*") == rows(chain, "*")


def test_anchors_are_the_rarest_runs(spark, monkeypatch):
    """Of a clause's runs the one that the fewest texts have."""
    monkeypatch.setattr(title_rules, "SHARE", 1)
    texts = spark.createDataFrame([("a long common beginning, and one",), ("a long common beginning, and two",), ("A LONG COMMON BEGINNING, none",)], "t string")
    found = [(1, "x", ["a long common beginning, and one"], None, None), (2, "y", ["a long common beginning"], None, None), (3, "z", ["a long common beginning, and three"], None, None), (4, "short", ["two"], ["one"], None)]
    table = clauses(spark.createDataFrame(found, RULES))
    got = anchored(texts, "t", table).join(table, "clause")
    assert rows(got, "label", "texts") == [("short", 1), ("x", 1), ("y", 3), ("z", 0)]


def test_a_thousand_rules_that_begin_alike_stay_linear(spark):
    """The pairs of texts and clauses that are tested don't grow with texts times rules."""
    prefix = "episode of the series with a name that all of them have, number "
    rules = spark.createDataFrame([(i, f"rule {i}", [f"{prefix}{i:04} of"], None, None) for i in range(1000)], RULES)
    texts = spark.createDataFrame([(f"{prefix.upper()}{i % 1200:04} of a season, {i}",) for i in range(2000)], "t string")
    table = clauses(rules)
    anchors = anchored(texts, "t", table)
    distinct = texts.select(F.md5("t").alias("_digest"), F.lower("t").alias("_text"))
    assert anchors.count() == 1000
    assert clauses_met(distinct, anchors).count() <= 20 * 2000
    chain = texts.select("t", F.concat(F.lit("rule "), F.substring("t", len(prefix) + 1, 4).cast("int").cast("string")).alias("label"))
    want = chain.withColumn("label", F.when(F.substring("t", len(prefix) + 1, 4).cast("int") < 1000, F.col("label")).otherwise("other"))
    assert rows(label_by_rules(texts, "t", rules, "label"), "*") == rows(want, "*")


def test_bloom_filter(spark, monkeypatch):
    """Everything in it passes, few others do; at its bound more pass, and labels stay right."""
    runs = spark.range(5000).select(F.xxhash64("id").alias("run"))
    others = spark.range(5000, 105_000).select(F.xxhash64("id").alias("run"))
    test = bloom(runs, 5000)
    assert runs.where(test(F.col("run"))).count() == 5000 and others.where(test(F.col("run"))).count() < 8000
    monkeypatch.setattr(title_rules, "MOST_BITS", 1 << 10)
    full = bloom(runs, 5000)
    assert runs.where(full(F.col("run"))).count() == 5000 and others.where(full(F.col("run"))).count() > 90_000
    texts = spark.createDataFrame([(f"title {i} of many",) for i in range(300)], "t string")
    rules = spark.createDataFrame([(i, f"r{i}", [f"title {i} "], None, None) for i in range(250)], RULES)
    chain = texts.select("t", title_series("t", title_rules_from(rules)).alias("label"))
    assert rows(label_by_rules(texts, "t", rules, "label"), "*") == rows(chain, "*")


def test_runs_are_dropped_before_they_become_rows(spark, titles):
    """The filter is inside the generator's array, below the explode, and the plan has no Python and no cross join."""
    table = clauses(table_of(spark))
    anchors = anchored(titles, "title", table)
    distinct = titles.select(F.md5("title").alias("_digest"), F.lower("title").alias("_text"))
    plan = clauses_met(distinct, anchors)._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode(flatten(array(array_distinct(filter(" in plan and "Cartesian" not in plan and "Python" not in plan
    assert phrase_runs(table).where("size > 8").count() == 0


def table_of(spark):
    return table(spark, sample_title_rules())
