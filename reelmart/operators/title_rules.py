"""Title rules as data: a join of texts with a rule table of any size.

:func:`~reelmart.functions.titles.title_series` makes rules part of the query text, which suits a few hundred; its work
is texts times rules. Here a clause is found by an anchor: of all the short runs of characters that its phrases consist
of, the one that the fewest texts have. A first pass counts those runs in a share of the texts, which decides only what
to look for and not what is found. The second pass joins the runs of all texts with the anchors and tests only the
clauses met, so rules that begin alike don't meet every text.

In both passes a Bloom filter of the runs looked for drops all others inside the array of a text's runs, before they
become rows. Its size follows the number of runs up to a fixed bound; beyond that it lets more pass and the join drops
them. Only the filter, the lengths of runs (nine at most) and no rule or text reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.functions import fixed_values as V
from reelmart.session import materialized

#: Characters of a run. A shorter phrase is a run by itself, looked for by runs of its own length.
ANCHOR = 8
#: Bits of a Bloom filter for each run in it, and at most (a megabyte, which is part of the query text).
BITS_PER_RUN, MOST_BITS = 16, 1 << 23
#: Runs are counted in one text of so many, by a hash of the text.
SHARE = 16


def _wide(text: Column) -> Column:
    """Four bytes a character, so that a run of characters is cut out without counting from the start."""
    return F.encode(text, "UTF-32")


def clauses(rules: DataFrame) -> DataFrame:
    """The rule table's rows with a number; a row that tests nothing is an error."""
    phrases = F.coalesce("contains", F.array().cast("array<string>"))
    nothing = F.raise_error(F.concat(F.lit("a clause of rule "), F.col("ordinal").cast("string"), F.lit(" tests nothing")))
    equals = F.when((F.size(phrases) == 0) & F.col("equals").isNull(), nothing.cast("string")).otherwise(F.col("equals"))
    rows = rules.select("ordinal", "label", phrases.alias("contains"), F.coalesce("lacks", F.array().cast("array<string>")).alias("lacks"), equals.alias("equals"))
    # as JSON, since hashes of arrays and nulls run into each other: [a, b], [] and [a], [b] hash alike
    whole = F.to_json(F.struct("ordinal", "label", "contains", "lacks", "equals"), {"ignoreNullFields": "false"})
    return rows.withColumn("clause", F.xxhash64(whole)).dropDuplicates(["ordinal", "label", "contains", "lacks", "equals"])


def _cut(text: Column, size: int | Column, count: Column) -> Column:
    """Hashes of the first ``count`` runs of ``size`` characters, from the first on."""
    starts = F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1)
    # an array of one, so that the text is widened once and not for every run
    cut = F.transform(F.array(_wide(text)), lambda w: F.transform(starts, lambda i: F.xxhash64(F.substring(w, i * 4 + 1, size * 4))))
    return F.when(count > 0, F.element_at(cut, 1)).otherwise(F.array().cast("array<long>"))


def phrase_runs(table: DataFrame) -> DataFrame:
    """(clause, size, run): the runs that a text must have for the clause to hold."""
    needed = F.concat("contains", F.when(F.col("equals").isNull(), F.array().cast("array<string>")).otherwise(F.array("equals")))
    phrases = table.select("clause", F.explode(needed).alias("phrase"))
    sized = phrases.withColumn("size", F.least(F.char_length("phrase"), F.lit(ANCHOR)))
    count = F.when(F.col("size") == 0, 1).otherwise(F.char_length("phrase") - F.col("size") + 1)
    return sized.select("clause", "size", F.explode(_cut(F.col("phrase"), F.col("size"), count)).alias("run")).distinct()


def bloom(runs: DataFrame, n: int) -> Callable[[Column], Column]:
    """A test that holds for every ``run`` of the table, which has n rows, and for few other numbers."""
    bits = 1 << 10
    while bits < min(BITS_PER_RUN * n, MOST_BITS):
        bits *= 2
    placed = runs.select(F.col("run").bitwiseAND(bits - 1).alias("place"))
    word, bit = F.shiftright("place", 6).cast("int").alias("word"), F.col("place").bitwiseAND(63).cast("int")
    # a shift by a column has no function of its own: the 64 values of a bit are a small array
    ones = F.array(*(F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(64)))
    filled = placed.groupBy(word).agg(F.bit_or(F.get(ones, bit)).alias("bits")).collect()  # bits / 64 rows at most
    words = [0] * (bits // 64)
    for row in filled:
        words[row.word] = row.bits
    table = F.split(F.lit(",".join(map(str, words))), ",").cast("array<long>")  # folded to a constant

    def test(run: Column) -> Column:
        # one place for each run: a second would cost more in every character than the few runs it drops
        return F.getbit(F.get(table, F.shiftright(run.bitwiseAND(bits - 1), 6).cast("int")), run.bitwiseAND(63).cast("int")) == 1

    return test


def _runs(text: Column, sizes: Iterable[int], wanted: Callable[[Column], Column]) -> Column:
    """Hashes of the distinct wanted runs of the given lengths; what they meet is tested in full."""

    def of(size: int) -> Column:
        count = F.char_length(text) - (size - 1) if size else F.lit(1)
        return F.array_distinct(F.filter(_cut(text, F.lit(size), count), wanted))

    return F.flatten(F.array(*map(of, sorted(sizes))))


def _sizes(runs: DataFrame) -> dict[int, int]:
    """How many runs there are of each length."""
    return {row["size"]: row["count"] for row in runs.groupBy("size").count().collect()}  # ANCHOR + 1 rows at most


def anchored(texts: DataFrame, text: str, table: DataFrame) -> DataFrame:
    """(clause, size, run, texts): the run of each clause that the fewest texts of a share of them have."""
    needed, _ = materialized(phrase_runs(table), "runs")
    sizes = _sizes(needed)
    if not sizes:
        return needed.select("clause", "size", "run", F.lit(0).cast("long").alias("texts"))
    part = texts.where(F.pmod(F.xxhash64(text), F.lit(SHARE)) == 0)
    found = part.select(F.explode(_runs(F.lower(text), sizes, bloom(needed, sum(sizes.values())))).alias("run")).groupBy("run").agg(F.count("*").alias("texts"))
    counted = needed.join(found, "run", "left").withColumn("texts", F.coalesce("texts", F.lit(0)))
    rarest = counted.groupBy("clause").agg(F.min(F.struct("texts", "run", "size")).alias("rarest"))
    anchors = rarest.select("clause", "rarest.size", "rarest.run", "rarest.texts")
    return materialized(anchors, "anchors")[0]  # read for the lengths, the filter and the join


def clauses_met(distinct: DataFrame, anchors: DataFrame) -> DataFrame:
    """(_digest, clause): the clauses whose anchors the texts (_digest, _text) have."""
    sizes = _sizes(anchors)
    runs = distinct.select("_digest", F.explode(_runs(F.col("_text"), sizes, bloom(anchors, sum(sizes.values())))).alias("run"))
    return runs.join(anchors.select("run", "clause"), "run").select("_digest", "clause")


def label_by_rules(texts: DataFrame, text: str, rules: DataFrame, name: str, default: str = V.NO_SERIES_NAME) -> DataFrame:
    """The rows with the label of the first rule that holds for the lower-case text, else ``default``.

    rules: ordinal, label, contains, lacks, equals; rows of one ordinal are alternatives. The anchors are chosen, and
    written to the shared folder, when this is called.
    """
    table = clauses(rules)
    anchors = anchored(texts, text, table)
    if anchors.isEmpty():
        return texts.withColumn(name, F.lit(default))
    lowered = F.lower(F.col(text))
    digest = F.unhex(F.md5(lowered))
    distinct = texts.where(F.col(text).isNotNull()).select(digest.alias("_digest"), lowered.alias("_text")).dropDuplicates(["_digest"])
    met = clauses_met(distinct, anchors)
    has = lambda p: F.call_function("contains", F.col("_text"), p)
    holds = F.forall("contains", has) & ~F.exists("lacks", has) & (F.col("equals").isNull() | (F.col("equals") == F.col("_text")))
    tested = met.join(distinct, "_digest").join(table, "clause").where(holds)
    first = tested.groupBy("_digest").agg(F.min(F.struct("ordinal", "label")).alias("_first"))
    keyed = texts.withColumn("_digest", digest).join(first, "_digest", "left")
    return keyed.select(*texts.columns, F.coalesce("_first.label", F.lit(default)).alias(name))
