"""Mixing sources to target weights by hash thresholds, with native aggregates alone.

A row's key is a hash of its id and text. Of every source, the rows below a threshold are taken once more than the others,
so a larger budget takes a superset of what a smaller one takes. The threshold is found from histograms of words by
source and leading bits of the key: the bucket in which the running sum crosses the budget is refined by the next bits, and
only its rows are read again, until it holds one row. Nothing is sorted but the histograms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigilog.llm.shared import stored, work_folder
from vigilog.operators.ranking import running_sums

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
KEY_BITS = 60
STEP_BITS = 10
WORD = r"[^\x20\x09-\x0D]+"
SENT_BYTES = 8 << 20  # of the table of sources: above this it isn't broadcast
SALTS = 64


def _text(docs: DataFrame) -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit("")) if "text" in docs.columns else F.lit("")


def row_keys(docs: DataFrame) -> dict[str, Column]:
    """``s`` (the source, never null), ``size`` in words, ``key``, and ``tie``, which tells rows of one key apart."""
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("")) if "doc_id" in docs.columns else F.lit("")
    digest = F.md5(F.concat_ws(" ", doc_id, F.md5(_text(docs).cast("binary"))).cast("binary"))
    return {
        "s": F.coalesce(F.concat(F.lit("="), source), F.lit("")),
        "size": F.regexp_count(_text(docs), F.lit(WORD)).cast("long"),
        "key": F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long"),
        "tie": F.xxhash64(F.monotonically_increasing_id()).bitwiseAND((1 << KEY_BITS) - 1),
    }


def targets(sources: DataFrame, weights: Sequence[int], budget: float, most: int) -> DataFrame:
    """``s``, ``source_size`` and ``target`` for sources with their sizes.

    Sources by code point, null last, have the weights in turn. Everyone's share is ``weight`` times one level, but at most
    ``most`` times its size; in the order of size by weight, those below the level are a prefix, which two running sums find.
    """
    null_last = F.when(F.col("s") == "", 1).otherwise(0)
    ranked = running_sums(sources, [null_last, F.col("s")], {"rank": F.lit(1).cast("long")})
    weight = F.get(F.array(*[F.lit(w).cast("long") for w in weights]), F.pmod("rank", F.lit(len(weights))).cast("int"))
    weighed = ranked.withColumn("weight", weight)
    ratio = F.col("source_size").cast("double") / F.col("weight")
    filled = running_sums(weighed, [ratio, F.col("rank")], {"used": F.col("source_size") * most, "gone": F.col("weight")})
    filled = stored(filled, work_folder(sources.sparkSession, "mix"), "sources")
    sums = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    total, all_weights = int((sums[0] or 0) * budget) if budget != 1 else sums[0] or 0, sums[1] or 0

    def exact(value) -> Column:
        return (value if isinstance(value, Column) else F.lit(value)).cast("decimal(19,0)")

    room = exact(F.col("source_size") * most) * exact(F.lit(all_weights) - F.col("gone"))
    capped = filled.withColumn("capped", room <= exact(F.col("weight")) * exact(F.lit(total) - F.col("used")))
    level = capped.agg(
        F.coalesce(F.sum(F.when(F.col("capped"), F.col("source_size") * most)), F.lit(0)),
        F.coalesce(F.sum(F.when(~F.col("capped"), F.col("weight"))), F.lit(0)),
    ).first()
    share = F.col("weight").cast("double") * float(total - level[0]) / float(level[1] or 1)
    target = F.when(F.col("capped"), (F.col("source_size") * most).cast("double")).otherwise(share)
    return capped.select("s", "source_size", target.alias("target"))


def thresholds(rows: DataFrame, wanted: DataFrame, folder: str) -> DataFrame:
    """``wanted`` with ``copies`` of every row, and the cut below which a row is taken once more.

    A row is below if its key is below ``key_cut``, or equal to it and its tie below ``tie_cut``. The cut comes as
    near to the target as a whole row can.
    """
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = wanted.withColumn("copies", copies).withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size"))
    plan = stored(plan, folder, "plan")

    found = plan.select("s", F.col("rest").alias("r"), F.lit(0).cast("long").alias("lo"), F.lit(0).cast("long").alias("below"), F.lit(0).cast("long").alias("key_lo"))
    found, inside, closed = found.where("r > 0"), rows, None
    for column in ("key", "tie"):
        found = found.withColumn("lo", F.lit(0).cast("long"))
        for bits in range(KEY_BITS - STEP_BITS, -1, -STEP_BITS):
            name, first = f"{column}-{bits}", column == "key" and bits + STEP_BITS == KEY_BITS
            bucket = F.shiftright(column, bits)
            if first:
                held = inside.select("s", "size", "key", "tie", bucket.alias("bucket"))
            else:
                # Found buckets are few rows of a (source, bucket) each, so no source is one join key.
                want = found.select("s", F.shiftright("lo", bits + STEP_BITS).alias("above"), *(["key_lo"] if column == "tie" else []))
                on = ["s", "above"] + (["key_lo"] if column == "tie" else [])
                above = {"above": F.shiftright(F.col(column), bits + STEP_BITS)} | ({"key_lo": F.col("key")} if column == "tie" else {})
                held = stored(inside.withColumns(above).join(want, on, "left_semi").select("s", "size", "key", "tie"), folder, f"inside-{name}")
                inside, held = held, held.withColumn("bucket", bucket)
            sums = held.groupBy("s", "bucket").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
            ahead = F.sum("words").over(Window.partitionBy("s").orderBy("bucket"))
            crossing = sums.withColumn("upto", ahead).join(found, "s").where("below + upto >= r")
            first_one = F.row_number().over(Window.partitionBy("s").orderBy("bucket"))
            found = crossing.withColumn("i", first_one).where("i = 1").select(
                "s", "r", F.shiftleft("bucket", bits).alias("lo"), (F.col("below") + F.col("upto") - F.col("words")).alias("below"), "words", "n",
                (F.shiftleft("bucket", bits) if column == "key" else F.col("key_lo")).alias("key_lo"),
            )
            found = stored(found.withColumn("width", F.lit(1 << bits).cast("long")), folder, f"found-{name}")
            single = found.where("n = 1")
            nearer = F.col("words") < 2 * (F.col("r") - F.col("below"))
            end = F.col("lo") + F.when(nearer, F.col("width")).otherwise(0)
            cut = {"key_cut": end if column == "key" else F.col("key_lo"), "tie_cut": F.lit(0).cast("long") if column == "key" else end}
            done = single.select("s", *[c.alias(k) for k, c in cut.items()])
            closed = done if closed is None else closed.union(done)
            found = found.where("n > 1").drop("words", "n", "width")
            if found.isEmpty():
                break
        if found.isEmpty():
            break
    if closed is None:
        raise RuntimeError("no round was made")
    return plan.join(closed, "s", "left").fillna(0, ["key_cut", "tie_cut"])


def _planned(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Every row beside its source's plan: broadcast while that is small, else dealt by source and salt."""
    size = plan.agg(F.coalesce(F.sum(F.octet_length("s") + 64), F.lit(0))).first()[0]
    if size <= SENT_BYTES:
        return rows.join(F.broadcast(plan), "s")
    salted = plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod("key", F.lit(SALTS)).cast("int")).join(salted, ["s", "salt"]).drop("salt")


def _copies() -> Column:
    below = (F.col("key") < F.col("key_cut")) | ((F.col("key") == F.col("key_cut")) & (F.col("tie") < F.col("tie_cut")))
    return F.col("copies") + F.when(below, 1).otherwise(0)


def mix_plan(rows: DataFrame, folder: str, weights: Sequence[int] = WEIGHTS, budget: float = 1.0, most: int = MOST_COPIES) -> DataFrame:
    """A row for each source of stored ``rows`` (those of ``row_keys``): its size, target, copies and cut."""
    sizes = rows.groupBy("s").agg(F.sum("size").alias("source_size"))
    return stored(thresholds(rows, targets(sizes, weights, budget, most), folder), folder, "cuts")


def mixed_sizes(docs: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = 1.0, most: int = MOST_COPIES) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` (words, repeats counted) for every row of ``docs``.

    The sources share ``budget`` times all words by ``weights``, none more than ``most`` times its own. A null text has no
    words, a null source is a source of its own, the last one; a table without the column has that one alone. Every
    source comes as near to its target as whole rows can. Equal rows (id and text) are taken one by one where the cut falls
    among them, and any of them may be the one. An empty table gives no rows. Other columns are ignored.
    """
    folder = work_folder(docs.sparkSession, "mix")
    doc_id = F.col("doc_id") if "doc_id" in docs.columns else F.lit(None).cast("long").alias("doc_id")
    rows = stored(docs.select(doc_id, *[c.alias(n) for n, c in row_keys(docs).items()]), folder, "rows")
    plan = mix_plan(rows, folder, weights, budget, most)
    taken = (F.col("size") * _copies()).alias("taken")
    return _planned(rows, plan).select("doc_id", "size", "source_size", "target", taken)


def mixture(docs: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = 1.0, most: int = MOST_COPIES) -> DataFrame:
    """The rows of ``docs``, unchanged, each as many times as the mix takes it; for the rest see ``mixed_sizes``.

    Rows without words are in the mix as often as the rows around them in the order of keys.
    """
    folder = work_folder(docs.sparkSession, "mix")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in row_keys(docs).items()])
    plan = mix_plan(stored(keyed.drop("row"), folder, "rows"), folder, weights, budget, most)
    times = _planned(keyed, plan).select("row", _copies().cast("int").alias("times")).where("times > 0")
    return times.select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")
