"""Mix sources to target weights by capped water-filling, in DataFrame functions only.

Every source has a size in words and a weight. The sum of all sizes is shared
out by weight; a source whose share would exceed `max_epochs` times its size is
held there and the excess goes to the others by weight, until none exceeds.
A source is then taken in whole repetitions and one seeded fractional one: its
documents are put in a seeded random order, the first are taken once more, and
the one at which the target is reached only up to the missing words. Rows of one
id and size share a place in that order; where the target is reached among them
they are taken in turn.

Sources are ordered by code point, null last, and take the weights in turn.

Defined cases: a null text has size 0; a null source is a source of its own; a
source without words has target 0; repeated rows count each; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keptvisit.operators.ranks import cumulate, row_numbers
from keptvisit.session import write_out

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 17
# Sources that a broadcast may hold; more are joined by a shuffle.
FEW_SOURCES = 100_000


def size_of(text: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def order_of(id: str, size: Column, seed: int) -> Column:
    """The place of a document in the seeded order of its source, as text."""
    return F.concat(
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit("null")))),
        F.lit(":"), size.cast("string"))


def weighted(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Sources with `number`, from 1 in code point order with null last, and their weight."""
    named = sources.filter(F.col("source").isNotNull())
    numbers = row_numbers(named.select("source"), "source", "number")
    after = (numbers.agg(F.max("number")).first()[0] or 0) + 1
    numbered = named.join(numbers, "source").unionByName(
        sources.filter(F.col("source").isNull()).withColumn("number", F.lit(after).cast("long")))
    table = F.array(*[F.lit(w).cast("long") for w in weights])
    return numbered.withColumn(
        "weight", F.get(table, ((F.col("number") - 1) % len(weights)).cast("int")))


def water_fill(sources: DataFrame, max_epochs: int) -> DataFrame:
    """`sources` (source_size, weight) with `target`.

    The level is the words per unit of weight of the sources below their cap.
    It only rises from round to round, so a source once held stays held, and
    each round is one aggregate of one row.
    """
    cap = F.col("source_size") * max_epochs
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, held = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) >= cap
        row = sources.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)).alias("capped"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("weight"),
            F.count(F.when(above, 1)).alias("held"),
        ).first()
        if row["held"] == held or row["weight"] == 0:
            break
        held, level = row["held"], (total - row["capped"]) / row["weight"]
    share = F.col("weight") * F.lit(level)
    return sources.withColumn(
        "target", F.when(share >= cap, cap.cast("double")).otherwise(share))


def recipe(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """What to take: the sized rows, and one row per source.

    Sized rows: id, source, size, order_key. Sources: source, source_size,
    number, weight, target, `repeats` (whole repetitions of every document),
    `cut_key`, `cut_words` and `cut_rows`: documents before `cut_key` in the seeded
    order are taken once more, the `cut_rows` at it with `cut_words` words in all,
    later ones not.
    """
    size = size_of(text)
    rows = write_out(docs.select(
        F.col(id).alias("id"), F.col(source).alias("source"), size.alias("size"),
    ).withColumn("order_key", order_of("id", F.col("size"), seed)), "sized")
    sums = write_out(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    sources = write_out(water_fill(write_out(weighted(sums, weights), "weighted"), max_epochs), "targets")
    sources = sources.withColumn(
        "repeats", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(0).cast("long")
    ).withColumn("rest", F.round("target").cast("long") - F.col("repeats") * F.col("source_size"))
    numbered = with_source(rows, sources.select("source", "number", "rest"))
    places = numbered.filter("rest > 0").groupBy("number", "rest", "order_key").agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    before = cumulate(places, ["number"], "order_key", ["size"])
    cuts = before.filter("size_before <= rest and rest < size_before + size").groupBy("number").agg(
        F.min(F.struct("order_key", (F.col("rest") - F.col("size_before")).alias("words"), "rows")).alias("cut"))
    # A rest that takes all documents needs no cut: every key comes before "~".
    sources = sources.join(cuts, "number", "left").select(
        "source", "source_size", "number", "weight", "target", "repeats",
        F.when(F.col("rest") <= 0, F.lit("")).otherwise(F.coalesce("cut.order_key", F.lit("~")))
        .alias("cut_key"),
        F.coalesce("cut.words", F.lit(0)).cast("long").alias("cut_words"),
        F.coalesce("cut.rows", F.lit(0)).cast("long").alias("cut_rows"))
    return rows, write_out(sources, "recipe")


def with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """`rows` with the columns of their source; few sources are broadcast, more are shuffled."""
    lookup = sources.withColumnRenamed("source", "_source")
    if sources.count() <= FEW_SOURCES:
        lookup = F.broadcast(lookup)
    return rows.join(lookup, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def in_turn(rows: DataFrame, sources: DataFrame, order: str) -> DataFrame:
    """`rows`, joined with their source's recipe, with `_turn`: the row's number among those at the cut.

    It counts from 0. Only rows of a cut that several share are written and laid out for it.
    """
    if sources.filter("cut_rows > 1").isEmpty():
        return rows.withColumn("_turn", F.lit(0).cast("long"))
    shared = (F.col(order) == F.col("cut_key")) & (F.col("cut_rows") > 1)
    tied = write_out(rows.filter(shared).withColumn("_place", F.monotonically_increasing_id()), "tied")
    turns = cumulate(tied.withColumn("_one", F.lit(1).cast("long")), ["number"], "_place", ["_one"])
    return rows.filter(~shared).withColumn("_turn", F.lit(0).cast("long")).unionByName(
        turns.select(*rows.columns, F.col("_one_before").cast("long").alias("_turn")))


def extra(order: Column, size: Column) -> Column:
    """Words of the fractional repetition, for rows of `in_turn`."""
    missing = F.col("cut_words") - F.col("_turn") * size
    return (F.when(order < F.col("cut_key"), size)
            .when(order == F.col("cut_key"), F.greatest(F.lit(0).cast("long"), F.least(size, missing)))
            .otherwise(F.lit(0).cast("long")))


def mix(docs: DataFrame, *, id: str = "doc_id", **options) -> DataFrame:
    """One row per input row: id, source, size, source_size, target, repeats, taken."""
    rows, sources = recipe(docs, id=id, **options)
    more = extra(F.col("order_key"), F.col("size"))
    return in_turn(with_source(rows, sources), sources, "order_key").select(
        F.col("id").alias(id), "source", "size", "source_size", "target", "repeats",
        (F.col("size") * F.col("repeats") + more).alias("taken"))


def sample(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", source: str = "source",
    chars: str | None = None, seed: int = SEED, **options,
) -> DataFrame:
    """The mixed rows of `docs`: whole repetitions, and the last one of a source cut to its words.

    `chars` names a column with the text's code points, which follows the text.
    Only the per-source recipe is joined, so no text is shuffled.
    """
    columns = docs.columns
    _, sources = recipe(docs, id=id, text=text, source=source, seed=seed, **options)
    wanted = sources.select(
        F.col("source").alias("_source"), F.col("repeats").alias("_repeats"),
        "number", "cut_key", "cut_words", "cut_rows")
    if sources.count() <= FEW_SOURCES:
        wanted = F.broadcast(wanted)
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"))
    own = own.select("doc", F.col(f"doc.`{source}`").alias("_key"), F.col(f"doc.`{id}`").alias("_id"),
                     size_of(f"doc.`{text}`").alias("_size"))
    rows = own.join(wanted, F.col("_key").eqNullSafe(F.col("_source")))
    rows = in_turn(rows.withColumn("_order", order_of("_id", F.col("_size"), seed)), sources, "_order")
    rows = rows.withColumn("_more", extra(F.col("_order"), F.col("_size")))
    whole = F.col("_repeats") + F.when((F.col("_more") == F.col("_size")) & (F.col("_size") > 0), 1).otherwise(0)
    partly = (F.col("_more") > 0) & (F.col("_more") < F.col("_size"))
    copies = F.concat(
        F.array_repeat(F.lit(0).cast("long"), whole.cast("int")),
        F.when(partly, F.array(F.col("_more"))).otherwise(F.array().cast("array<long>")))
    rows = rows.select("doc", F.explode(copies).alias("_words"))
    head = F.when(F.col("_words") > 0, first_words(f"doc.`{text}`"))

    def out(column: str) -> Column:
        old = F.col(f"doc.`{column}`")
        if column == text:
            old = F.coalesce(head, old)
        elif column == chars:
            old = F.coalesce(F.length(head).cast(docs.schema[column].dataType), old)
        return old.alias(column)

    return rows.select(*[out(c) for c in columns])


def first_words(text: str) -> Column:
    """The text up to the end of its first `_words` words: the words and the gaps between them."""
    words = F.regexp_extract_all(F.col(text), F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    return F.concat_ws("", F.slice(words, F.lit(1), F.col("_words").cast("int")))


def oracle(
    table: str = "documents", weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> str:
    """DuckDB SQL for `mix` without its source and repeats columns."""
    turns = " ".join(f"when {i} then {w}" for i, w in enumerate(weights))
    return f"""
with texts as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''),
    '[^\\x20\\x09-\\x0D]+')) as bigint) as size from {table}),
sums as (
  select source, cast(sum(size) as bigint) as source_size,
    row_number() over (order by source nulls last) as number from texts group by source),
weighted as (
  select *, case (number - 1) % {len(weights)} {turns} end as weight,
    {max_epochs} * source_size as cap from sums),
levels as (
  select *, (sum(source_size) over () - coalesce(sum(cap) over w, 0))
    / cast(sum(weight) over () - coalesce(sum(weight) over w, 0) as double) as level
  from weighted window w as (order by cast(cap as double) / weight, number
    rows between unbounded preceding and 1 preceding)),
final as (
  select max(level) as level from levels),
targets as (
  select source, source_size, least(weight * level, cast(cap as double)) as target
  from weighted, final),
parts as (
  select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end
    as repeats from targets),
placed as (
  select doc_id, size, source_size, target, repeats,
    cast(round(target) as bigint) - repeats * source_size as rest,
    coalesce(sum(size) over (partition by t.source order by
      md5('{seed}:' || coalesce(cast(doc_id as varchar), 'null')) || ':' || size
      rows between unbounded preceding and 1 preceding), 0) as before
  from texts t join parts p on t.source is not distinct from p.source)
select doc_id, size, source_size, target,
  cast(size * repeats + least(size, greatest(0, rest - before)) as bigint) as taken
from placed"""
