"""Prefix trie of conversations, as a burst trie.

A node stands for a distinct sequence of first turns; a turn is its role and text. A container
holds the rest of all conversations that begin with one sequence. It is oversized if it has more
than ``LIMIT`` turns (and ends); an oversized container bursts: its sequence becomes a head of the trie, and its
conversations go on to containers by their next turn id.

1. Every turn gets an id (128 bits of hashes of role and text) and every prefix of a conversation a
   key: the xor of hashes of (place, turn id), a running value that is summed block by block,
   so that no task holds a whole conversation.
2. Bursting goes on in strides of 1, 2, 4, ... levels, for the conversations whose container is still
   oversized: the sizes of all containers of a stride are one aggregate over prefix keys.
   A head that a third of all conversations share is an aggregate like any other.
3. The remaining containers, of ``LIMIT`` rows at most, go to tasks. There the suffixes are sorted and swept:
   a stack holds the nodes of the last suffix, and what lies beyond the prefix shared with the next one is closed.
4. Heads get their totals from one row per (conversation, head): every head and container is charged to
   the least conversation in it, suffix sums run down the conversation, and heads add up
   the sums of their members.

Node columns: conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves,
saved_tokens, ends_sha256, and turn_1, turn_2, the id of its last turn (null at the root).

Defined results
- turns of a conversation stand by turn (null first), then by a digest of role and text, so ties and repeated rows
  have one order and all count; null role or text is empty.
- rows without a conv_id belong to no conversation.
- a conversation without turns is a member of the root alone and ends there.
- no conversations: no nodes. Extra columns are ignored.
- exact up to collisions of 128-bit keys.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricestrata.llm import ordering, texts
from pricestrata.operators import ordered

#: Turns and ends in a container that one task sweeps.
LIMIT = 20_000
#: Levels of a conversation that one task runs through.
BLOCK = 4_096
#: The contract's words (fixed value).
WORDS = r"[^\x20\x09-\x0D]+"
NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string, turn_1 bigint, turn_2 bigint"
)
NAMES = [c.split()[0] for c in NODE.split(", ")]


# --- conversations


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, number from 0, t1, t2, words) of all turns; t1 and t2 are the turn id."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("t1"), F.xxhash64(F.lit(2), text, role).alias("t2"),
        F.regexp_count(text, F.lit(WORDS)).cast("bigint").alias("words"),
    )
    return ordering.numbered(rows, ["conv_id"], ["turn", "t1", "t2"]).drop("turn")


def rebuilt(own: DataFrame, family: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """(conversations, their turns) after each took over the opening of its family's first one.

    Conversation c begins with the first h turns of c - c % ``family``, h = crc32(c) % ``most``, and goes
    on with its own turns after its first h.
    """
    base = F.col("conv_id") - F.col("conv_id") % family
    taken = F.crc32(F.col("conv_id").cast("string")) % most
    sizes = texts.stored(own.groupBy("conv_id").agg(F.count("*").alias("n")), "conversations")
    openings = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = sizes.select("conv_id", base.alias("base"), taken.alias("h")).join(openings, "base", "left")
    convs = convs.select("conv_id", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("first"))
    convs = texts.stored(convs, "openings")
    opening = own.where(F.col("number") < most - 1).select(F.col("conv_id").alias("base"), "number", "t1", "t2", "words")
    opening = opening.join(convs.where("first > 0").hint("rebalance"), "base").where("number < first")
    rest = own.join(convs.select("conv_id", "h", "first").hint("rebalance"), "conv_id").where("number >= h")
    made = opening.select("conv_id", (F.col("number") + 1).alias("depth"), "t1", "t2", "words").unionByName(
        rest.select("conv_id", (F.col("number") - F.col("h") + F.col("first") + 1).alias("depth"), "t1", "t2", "words")
    )
    return sizes.select("conv_id"), made


# --- prefixes and bursting


def prefixes(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The turns with key (p1, p2) and parent's key (q1, q2) of the prefix they end, and the
    conversation's length, stored."""
    rows = rows.withColumns({
        "x1": F.xxhash64(F.lit(3), "depth", "t1", "t2"), "x2": F.xxhash64(F.lit(4), "depth", "t2", "t1"),
        "block": F.floor(F.col("depth") / block),
    })
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    across = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    blocks = rows.groupBy("conv_id", "block").agg(
        F.bit_xor("x1").alias("y1"), F.bit_xor("x2").alias("y2"), F.max("depth").alias("last")
    )
    blocks = blocks.select(
        "conv_id", "block", F.max("last").over(whole).alias("size"),
        *(F.coalesce(F.bit_xor(f"y{i}").over(across), F.lit(0)).alias(f"c{i}") for i in (1, 2)),
    )
    run = rows.withColumns({f"z{i}": F.bit_xor(f"x{i}").over(inside) for i in (1, 2)})
    run = run.join(blocks.hint("rebalance"), ["conv_id", "block"])
    for i in (1, 2):
        run = run.withColumn(f"p{i}", F.col(f"z{i}").bitwiseXOR(F.col(f"c{i}")))
        run = run.withColumn(f"q{i}", F.col(f"p{i}").bitwiseXOR(F.col(f"x{i}")))
    names = ("conv_id", "depth", "size", "p1", "p2", "q1", "q2", "t1", "t2", "words")
    return texts.stored(run.select(*names), "prefixes")


def burst(keyed: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(conv_id, top): the depth at which each conversation meets a container that is not
    oversized; one beyond its length if it ends in a head. The root always bursts."""
    done, going = [], None
    low, width = 1, 1
    while True:
        level = keyed.where(F.col("depth").between(low, low + width - 1)).select("conv_id", "depth", "size", "p1", "p2")
        if going is not None:
            level = level.join(going, "conv_id", "left_semi")
        sizes = level.groupBy("depth", "p1", "p2").agg(F.sum(F.col("size") - F.col("depth") + 1).alias("n"))
        big = sizes.where(F.col("n") > limit).select("depth", "p1", "p2", F.lit(1).alias("big"))
        met = level.join(big.hint("rebalance"), ["depth", "p1", "p2"], "left")
        met = met.groupBy("conv_id").agg(F.count("big").alias("heads"), F.max("size").alias("size"))
        met = texts.stored(met, "burst")
        on = (F.col("heads") == width) & (F.col("size") >= low + width)
        done.append(met.where(~on).select("conv_id", (F.col("heads") + low).alias("top")))
        going = met.where(on).select("conv_id")
        if going.isEmpty():
            break
        low, width = low + width, width * 2
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


# --- containers


def swept(rows: list[tuple]) -> list[list]:
    """The nodes of one container from its (conv_id, depth, t1, t2, words) rows, in that order.

    The parent of the container's own node is None: it is a head, known elsewhere.
    """
    paths: list[tuple[list, int, list]] = []
    for conv, _, a, b, words in rows:
        if not paths or paths[-1][1] != conv:
            paths.append(([], conv, []))
        paths[-1][0].append((a, b))
        paths[-1][2].append(words)
    paths.sort(key=lambda p: (p[0], p[1]))
    top = rows[0][1]
    nodes: list[dict] = []
    stack: list[int] = []

    def close(keep: int) -> None:
        while len(stack) > keep:
            node = nodes[stack.pop()]
            node["saved"] += (node["convs"] - 1) * node["words"]
            node["leaves"] = node["leaves"] or 1
            if stack:
                above = nodes[stack[-1]]
                above["conv"] = min(above["conv"], node["conv"])
                above["convs"] += node["convs"]
                above["children"] += 1
                above["leaves"] += node["leaves"]
                above["saved"] += node["saved"]

    last: list = []
    for path, conv, words in paths:
        share = 0
        while share < min(len(path), len(last)) and path[share] == last[share]:
            share += 1
        close(share)
        for k in range(share, len(path)):
            nodes.append({
                "parent": stack[-1] if stack else None, "depth": top + k, "turn": path[k], "words": words[k],
                "conv": conv, "convs": 0, "children": 0, "leaves": 0, "saved": 0, "ends": [],
            })
            stack.append(len(nodes) - 1)
        end = nodes[stack[-1]]
        end["convs"] += 1
        end["conv"] = min(end["conv"], conv)
        end["ends"].append(conv)
        last = path
    close(0)
    return [
        [
            n["conv"], n["depth"], None if n["parent"] is None else nodes[n["parent"]]["conv"], n["convs"],
            n["children"], n["leaves"], n["saved"],
            hashlib.sha256(",".join(map(str, n["ends"])).encode()).hexdigest(), *n["turn"],
        ]
        for n in nodes
    ]


def containers(keyed: DataFrame, tops: DataFrame) -> DataFrame:
    """The nodes of all containers; top nodes carry the key (q1, q2) of their head, others null."""
    rows = keyed.join(tops.hint("rebalance"), "conv_id").where("depth >= top")
    of = rows.where("depth = top").select(
        "conv_id", F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.col("q1").alias("h1"), F.col("q2").alias("h2")
    )
    rows = rows.join(of.hint("rebalance"), "conv_id")
    part = ("top", "k1", "k2")
    rows = rows.select(*part, "h1", "h2", "conv_id", "depth", "t1", "t2", "words")
    rows = rows.repartition(*part).sortWithinPartitions(*part, "conv_id", "depth")
    schema = pa.schema([
        *((n, pa.string() if n == "ends_sha256" else pa.int64()) for n in NAMES), ("h1", pa.int64()), ("h2", pa.int64())
    ])

    def run(batches):
        held: list[tuple] = []
        key = None
        out: list[list] = []

        def settle():
            for n in swept([r[5:] for r in held]):
                out.append([*n, *(held[0][3:5] if n[2] is None else (None, None))])

        def made():
            batch = pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema
            )
            out.clear()
            return batch

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[:3] != key:
                    settle()
                    held = []
                    if len(out) > 20_000:
                        yield made()
                key = row[:3]
                held.append(row)
        if held:
            settle()
        yield made()

    return texts.stored(rows.mapInArrow(run, NODE + ", h1 bigint, h2 bigint"), "containers")


# --- heads


def ends_of(rows: DataFrame) -> DataFrame:
    """(depth, p1, p2, ends_sha256) from (depth, p1, p2, conv_id): ids run through the digest in
    order, one at a time, so memory does not grow with a node's ends."""
    part = ("depth", "p1", "p2")
    rows = rows.select(*part, "conv_id").repartition(*part).sortWithinPartitions(*part, "conv_id")

    def run(batches):
        key, digest, out = None, None, []

        def made():
            return pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], pa.string() if i == 3 else pa.int64()) for i in range(4)],
                names=[*part, "ends_sha256"],
            )

        for batch in batches:
            for *own, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own == key:
                    digest.update(f",{conv}".encode())
                    continue
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = own, hashlib.sha256(str(conv).encode())
                if len(out) > 20_000:
                    yield made()
                    out = []
        if key is not None:
            out.append((*key, digest.hexdigest()))
        yield made()

    return rows.mapInArrow(run, "depth bigint, p1 bigint, p2 bigint, ends_sha256 string")


def heads(convs: DataFrame, keyed: DataFrame, tops: DataFrame, inner: DataFrame, block: int) -> DataFrame:
    """The nodes of all heads and the root, stored, with their key (p1, p2)."""
    key = ["depth", "p1", "p2"]
    zero = F.lit(0).cast("bigint")
    size = keyed.where("depth = 1").select("conv_id", "size")
    root = convs.join(size, "conv_id", "left").select(
        "conv_id", zero.alias("depth"), F.coalesce("size", zero).alias("size"),
        *(zero.alias(c) for c in ("p1", "p2", "q1", "q2", "t1", "t2", "words")),
    )
    path = keyed.join(tops.hint("rebalance"), "conv_id").where("depth < top").drop("top").unionByName(root)
    path = texts.stored(path, "head-paths")
    made = path.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        *(F.min(c).alias(c) for c in ("q1", "q2", "t1", "t2")),
    )
    made = texts.stored(made, "heads")
    tops_in = inner.where("h1 is not null").select(
        "conv_id", "depth", F.col("h1").alias("q1"), F.col("h2").alias("q2"), "n_leaves", "saved_tokens"
    )
    below = made.where("depth > 0").select("depth", "q1", "q2").unionByName(tops_in.select("depth", "q1", "q2"))
    below = below.groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2"))
    made = texts.stored(
        made.join(below.agg(F.count("*").alias("n_children")), key, "left").fillna(0, ["n_children"]), "heads"
    )
    # What is charged to (conversation, depth): own savings of a head, the totals of a container.
    charged = made.select(
        "conv_id", "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("s"),
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint").alias("l"),
    ).unionByName(tops_in.select("conv_id", (F.col("depth") - 1).alias("depth"),
                                 F.col("saved_tokens").alias("s"), F.col("n_leaves").alias("l")))
    charged = charged.groupBy("conv_id", "depth").agg(F.sum("s").alias("s"), F.sum("l").alias("l"))
    runs = path.select("conv_id", *key).join(charged.hint("rebalance"), ["conv_id", "depth"], "left")
    runs = runs.fillna(0, ["s", "l"]).withColumn("up", -F.col("depth"))
    cut = F.floor(F.col("up") / block)
    for c in ("s", "l"):
        runs = ordered.running(runs, ["conv_id"], ["up"], F.col(c), cut, f"sum_{c}")
    sums = runs.groupBy(*key).agg(F.sum("sum_s").alias("saved_tokens"), F.sum("sum_l").alias("n_leaves"))
    ends = ends_of(path.where("depth = size"))
    parents = made.select(
        (F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    none = hashlib.sha256(b"").hexdigest()
    made = made.join(sums, key).join(ends, key, "left").join(parents, ["depth", "q1", "q2"], "left")
    turn = [F.when(F.col("depth") > 0, F.col(f"t{i}")).alias(f"turn_{i}") for i in (1, 2)]
    return texts.stored(
        made.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(none)))
        .select(*NAMES[:-2], *turn, "p1", "p2"), "head-nodes",
    )


def nodes(convs: DataFrame, rows: DataFrame, limit: int = LIMIT, block: int = BLOCK) -> DataFrame:
    """All nodes of the trie of ``convs`` (conv_id) with their turns ``rows`` (conv_id, depth from
    1, t1, t2, words)."""
    keyed = prefixes(rows, block)
    tops = burst(keyed, limit)
    inner = containers(keyed, tops)
    made = heads(convs, keyed, tops, inner, block)
    above = made.select(
        (F.col("depth") + 1).alias("depth"), F.col("p1").alias("h1"), F.col("p2").alias("h2"),
        F.col("conv_id").alias("_above"),
    )
    inner = inner.join(above.hint("rebalance"), ["depth", "h1", "h2"], "left")
    inner = inner.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above"))
    return made.select(*NAMES).unionByName(inner.select(*NAMES))


def prefix_trie(conversations: DataFrame, limit: int = LIMIT, block: int = BLOCK) -> DataFrame:
    """The trie of the conversations as they are stored."""
    own = turns(conversations)
    convs = texts.stored(own.select("conv_id").distinct(), "conversations")
    return nodes(convs, own.withColumn("depth", F.col("number") + 1).drop("number"), limit, block)


def rebuilt_trie(conversations: DataFrame, limit: int = LIMIT, block: int = BLOCK) -> DataFrame:
    """The trie of the rebuilt conversations (see ``rebuilt``)."""
    return nodes(*rebuilt(turns(conversations)), limit, block)
