"""Mixing sources to target weights by pivotal dependent rounding. Built-in functions only.

Every source gets a target share of all words. A document of a source is taken target / source
size times: a whole number of times, and once more with the fractional rest as probability.
The rests are rounded in pairs: of two documents one gives words to the other, in the
direction that chance decides, until one of the two is wholly in or wholly out. Words are moved, not
probabilities, so the expected words of a source never change, and when
all are settled, its taken words miss the target by less than its last document.

The pairs form a reduction tree. Documents of a source stand in a random but reproducible order; every
``FAN`` neighbours are settled in one group, from the longest to the shortest text, and leave one
unsettled document at most. These residuals are grouped by ``FAN`` again, until one is left, which chance
settles alone. A source that holds a third of all rows is thus cut into groups of ``FAN`` rows; only
ids and sizes are shuffled, never texts.

Targets: ``WEIGHTS`` repeat over the sources in order of their names (code points, null last) and share all
words. A target stops at ``MOST`` times its source; what it exceeds goes to the others by
weight, until none is above. Each round of this is one aggregate over the sources.

Defined results
- null text or one without words: size 0, taken 0. Null doc_id: kept. Null source: a source of its own.
- repeated rows are rounded one by one; which of two equal rows is taken does not show.
- no words at all: targets 0. No rows: an empty result. Extra columns are ignored.
- the order depends on the seed, doc_id, size and source alone, so runs agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricestrata.llm import ordering, texts

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 20_240_613
#: Documents that are settled in one group.
FAN = 128
#: The contract's words (fixed value).
WORDS = r"[^\x20\x09-\x0D]+"
#: Probabilities this close to 0 or 1 are settled.
_NEAR = 1e-12


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size) of every document, stored."""
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORDS))
    return texts.stored(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
            words.cast("bigint").alias("size"),
        ),
        "sized",
    )


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(rank, source, source_size, target) of every source, stored."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = ordering.numbered(sizes.withColumn("last", F.col("source").isNull()), [], ["last", "source"], "rank")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.select("rank", "source", "source_size", weight.alias("w"), (F.col("source_size") * most).alias("cap"))
    ranked = texts.stored(ranked, "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    each, before = 0.0, -1
    while True:
        full = F.col("cap") < F.col("w") * F.lit(each)
        n, held, open_ = ranked.agg(
            F.count_if(full), F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("w")))
        ).first()
        if n == before or not open_:
            break
        each, before = (total - (held or 0)) / open_, n
    target = F.least(F.col("cap").cast("double"), F.col("w") * F.lit(float(each)))
    return texts.stored(ranked.select("rank", "source", "source_size", target.alias("target")), "targets")


# --- rounding


def _chance(*by: Column | str) -> Column:
    """A number in [0, 1) that depends on the seed and ``by`` alone."""
    return F.pmod(F.xxhash64(F.lit(SEED), *by), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _bound(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _met(state: Column, b: Column) -> Column:
    """The state after its unsettled document, if any, met ``b``."""
    a = state["open"]
    item = lambda x, p: F.struct(x["number"].alias("number"), x["size"].alias("size"), x["doc_id"].alias("doc_id"), p.alias("p"))
    moved = F.struct(
        ((1.0 - a["p"]) * a["size"]).alias("a_up"), (a["p"] * a["size"]).alias("a_down"),
        ((1.0 - b["p"]) * b["size"]).alias("b_up"), (b["p"] * b["size"]).alias("b_down"),
    )

    def settled(m: Column) -> Column:
        gain, loss = F.least(m["a_up"], m["b_down"]), F.least(m["a_down"], m["b_up"])
        rises = b["u"] * (gain + loss) < loss
        p = F.when(rises, F.when(m["a_up"] <= m["b_down"], 1.0).otherwise(a["p"] + gain / a["size"]))
        p = p.otherwise(F.when(m["a_down"] <= m["b_up"], 0.0).otherwise(a["p"] - loss / a["size"]))
        q = F.when(rises, F.when(m["b_down"] <= m["a_up"], 0.0).otherwise(b["p"] - gain / b["size"]))
        q = q.otherwise(F.when(m["b_up"] <= m["a_down"], 1.0).otherwise(b["p"] + loss / b["size"]))
        clean = lambda x: F.when(x < _NEAR, 0.0).when(x > 1.0 - _NEAR, 1.0).otherwise(x)
        return F.array(item(a, clean(p)), item(b, clean(q)))

    def after(pair: Column) -> Column:
        done = F.filter(pair, lambda x: (x["p"] == 0.0) | (x["p"] == 1.0))
        rest = F.filter(pair, lambda x: (x["p"] > 0.0) & (x["p"] < 1.0))
        return F.struct(F.get(rest, F.lit(0)).alias("open"), F.concat(state["done"], done).alias("done"))

    met = _bound(_bound(moved, settled), after)
    return F.when(a.isNull(), F.struct(item(b, b["p"]).alias("open"), state["done"].alias("done"))).otherwise(met)


def folded(rows: DataFrame, fan: int) -> DataFrame:
    """(rank, chunk, number, size, doc_id, p): each ``fan`` neighbours of a source settled but for
    one at most. Rows have rank, place, number, size, doc_id, p and u."""
    kind = "struct<number:bigint,size:bigint,doc_id:bigint,p:double>"
    chunk = F.floor(F.col("place") / fan).cast("bigint").alias("chunk")
    member = F.struct((-F.col("size")).alias("k"), "number", "size", "doc_id", "p", "u")
    groups = rows.groupBy("rank", chunk).agg(F.array_sort(F.collect_list(member)).alias("members"))
    start = F.struct(F.lit(None).cast(kind).alias("open"), F.array().cast(f"array<{kind}>").alias("done"))
    whole = F.aggregate(
        "members", start, _met,
        lambda s: F.when(s["open"].isNull(), s["done"]).otherwise(F.concat(s["done"], F.array(s["open"]))),
    )
    return groups.select("rank", "chunk", F.inline(whole))


def rounded(rows: DataFrame, fan: int = FAN) -> DataFrame:
    """(rank, doc_id, size, up) from (rank, doc_id, size, p) with sizes above 0 and 0 < p < 1."""
    rows = rows.withColumn("order", F.xxhash64(F.lit(SEED), "rank", "doc_id", "size"))
    rows = ordering.numbered(rows, ["rank"], ["order", "doc_id", "size"])
    level = rows.select(
        "rank", F.col("number").alias("place"), "number", "size", "doc_id", "p", _chance(F.lit(0), "rank", "number").alias("u")
    )
    open_ = (F.col("p") > 0.0) & (F.col("p") < 1.0)
    first = late = None
    depth = 0
    while True:
        made = texts.stored(folded(level, fan), "rounded")
        depth += 1
        if first is None:
            first = made
        else:
            some = made.where(~open_).select("rank", "number", "p")
            late = some if late is None else late.unionByName(some)
        rest = made.where(open_)
        if not (rest.agg(F.max("chunk")).first()[0] or 0):
            break
        level = rest.select(
            "rank", F.col("chunk").alias("place"), "number", "size", "doc_id", "p",
            _chance(F.lit(depth), "rank", "chunk").alias("u"),
        )
    # The last document of a source has none to meet.
    alone = F.when(_chance(F.lit(-1), "rank") < F.col("p"), 1.0).otherwise(0.0)
    last = rest.select("rank", "number", alone.alias("p"))
    late = last if late is None else late.unionByName(last)
    late = late.withColumnRenamed("p", "late").hint("rebalance")
    return first.join(late, ["rank", "number"], "left").select(
        "rank", "doc_id", "size", F.coalesce("late", "p").cast("int").alias("up")
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, fan: int = FAN) -> DataFrame:
    """doc_id, size, source_size, target, taken, source and copies of every document."""
    rows = sized(docs)
    sources = targets(rows, weights, most)
    named = sources.select("rank", F.col("source").alias("_source"), "source_size", "target")
    wish = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size")))
    wish = F.coalesce(wish, F.lit(0.0))
    rows = rows.join(named.hint("rebalance"), F.col("source").eqNullSafe(F.col("_source")))
    rows = rows.withColumn("base", F.floor(wish + _NEAR).cast("int")).withColumn("p", wish - F.col("base"))
    rows = texts.stored(rows.select("rank", "doc_id", "size", "base", "p"), "wishes")
    unsettled = (F.col("size") > 0) & (F.col("p") > _NEAR)
    up = rounded(rows.where(unsettled).select("rank", "doc_id", "size", "p"), fan)
    up = up.unionByName(rows.where(~unsettled).select("rank", "doc_id", "size", F.lit(0).alias("up")))
    bases = rows.groupBy("rank").agg(F.max("base").alias("base"))
    known = sources.join(bases, "rank").hint("rebalance")
    copies = F.when(F.col("size") > 0, F.col("base") + F.col("up")).otherwise(0)
    return up.join(known, "rank").select(
        "doc_id", "size", "source_size", "target", (copies * F.col("size")).cast("bigint").alias("taken"),
        "source", copies.cast("int").alias("copies"),
    )
