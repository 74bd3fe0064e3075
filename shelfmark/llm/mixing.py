"""Mixing overlapping sources to target weights with a min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong to), so the flow
network has one node for each pattern and each source, whatever the number of documents. Tokens
are routed from patterns to source quotas; taking a pattern again costs more each time, so
repetition is spread evenly. Whole documents are then selected in a seeded order until a pattern's
flow is met.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfmark.llm.common import WORD_PATTERN, Staging

#: Times a document may be taken at most.
MAX_EPOCHS = 3
#: Bits of the seeded order; its first BUCKET_BITS make the histogram that finds the cut.
ORDER_BITS = 60
BUCKET_BITS = 12
#: Rounds of filling what is left of a quota with ever smaller documents.
FILLS = 3
#: Patterns the flow network may have; more is an error, never a sample. It bounds the tables that are broadcast:
#: they have one row of a few numbers for each pattern.
MAX_PATTERNS = 100_000


def water_fill(sizes: list[int], weights: list[int], most: int = MAX_EPOCHS) -> list[Fraction]:
    """Share the total size by weight; shares stop at ``most`` times the size and the excess is shared again."""
    total, capped = sum(sizes), [False] * len(sizes)
    while True:
        left = total - sum(most * s for s, c in zip(sizes, capped, strict=True) if c)
        weight = sum(w for w, c in zip(weights, capped, strict=True) if not c)
        shares = [
            Fraction(most * s) if c else Fraction(left * w, weight) for s, w, c in zip(sizes, weights, capped, strict=True)
        ]
        over = [not c and x > most * s for s, x, c in zip(sizes, shares, capped, strict=True)]
        if not any(over):
            return shares
        capped = [c or o for c, o in zip(capped, over, strict=True)]


def route(sizes: list[int], members: list[list[int]], quotas: list[int], most: int = MAX_EPOCHS) -> list[int]:
    """Tokens each pattern gives, by successive cheapest augmenting paths.

    Arc ``e`` of a pattern (its e-th repetition) carries up to its size at cost ``e``: convex, so
    first uses are exhausted before any repetition. ``members[p]`` are the sources that pattern p
    may serve. Ties go to the smaller pattern, then the smaller source.
    """
    given = [0] * len(sizes)
    left = list(quotas)
    flow: list[dict[int, int]] = [dict.fromkeys(m, 0) for m in members]
    feeders: list[list[int]] = [[] for _ in quotas]
    for p, m in enumerate(members):
        for s in m:
            feeders[s].append(p)
    for epoch in range(most):
        # All paths of cost `epoch` start at patterns in their epoch-th use; saturate them before the next cost.
        blocked = [False] * len(sizes)
        for p in range(len(sizes)):
            while given[p] < (epoch + 1) * sizes[p] and not blocked[p]:
                came: dict[tuple[str, int], tuple[str, int] | None] = {("p", p): None}
                queue, end = [("p", p)], None
                for kind, i in queue:
                    if kind == "p":
                        steps = [("s", s) for s in members[i]]
                    elif left[i]:
                        end = i
                        break
                    else:
                        steps = [("p", q) for q in feeders[i] if flow[q][i]]
                    for step in steps:
                        if step not in came:
                            came[step] = (kind, i)
                            queue.append(step)
                if end is None:
                    blocked[p] = True
                    break
                path, node = [], ("s", end)
                while node is not None:
                    path.append(node)
                    node = came[node]
                path.reverse()
                amount = min((epoch + 1) * sizes[p] - given[p], left[end])
                for (k, i), (_, j) in zip(path, path[1:], strict=False):
                    if k == "s":
                        amount = min(amount, flow[j][i])
                for (k, i), (_, j) in zip(path, path[1:], strict=False):
                    if k == "p":
                        flow[i][j] += amount
                    else:
                        flow[j][i] -= amount
                given[p] += amount
                left[end] -= amount
    return given


def _cut(rows: DataFrame, wanted: DataFrame, turn: int) -> DataFrame:
    """``(pattern, upto_<turn>, room_<turn>)``: documents no larger than the room are taken up to that order.

    ``rows``: open documents (pattern, size, ord); ``wanted``: (pattern, room). The largest prefix in
    seeded order whose sizes do not exceed the room. A histogram finds the bucket of the cut, so that
    only that bucket's rows are ordered.
    """
    fitting = rows.join(F.broadcast(wanted), "pattern").where("size <= room AND size > 0 AND room > 0")
    shift = ORDER_BITS - BUCKET_BITS
    buckets = (
        fitting.groupBy("pattern", F.expr(f"ord >> {shift}").alias("bucket"))
        .agg(F.sum("size").alias("mass"), F.first("room").alias("room"))
        .withColumn("upto", F.sum("mass").over(Window.partitionBy("pattern").orderBy("bucket")))
    )
    edge = buckets.where("upto > room").groupBy("pattern").agg(F.min("bucket").alias("edge"))
    whole = buckets.join(edge, "pattern", "left").where("edge IS NULL OR bucket < edge")
    base = whole.groupBy("pattern").agg(F.sum("mass").alias("base"), F.max("bucket").alias("last"))
    inside = fitting.join(F.broadcast(edge), "pattern").where(f"ord >> {shift} = edge")
    inside = inside.join(F.broadcast(base.select("pattern", "base")), "pattern", "left")
    run = F.sum("size").over(Window.partitionBy("pattern").orderBy("ord")) + F.coalesce("base", F.lit(0))
    taken = inside.withColumn("run", run).where("run <= room").groupBy("pattern").agg(F.max("ord").alias("at"), F.max("run").alias("run"))
    cut = wanted.join(base, "pattern", "left").join(taken, "pattern", "left")
    return cut.selectExpr(
        "pattern",
        f"coalesce(at, ((last + 1) << {shift}) - 1, -1) AS upto_{turn}",
        f"room AS room_{turn}",
        "room - coalesce(run, base, 0) AS room",
    )


def mix_sources(
    documents: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    seed: int = 17,
    key: str = "doc_id",
    text: str = "text",
    sources: str = "source",
) -> DataFrame:
    """``(key, size, source_size, target, taken, epochs)`` for every row of ``documents``.

    ``sources`` names a string column (one source a document) or an array of strings (overlapping
    sources: a document counts in each of them; ``source_size`` and ``target`` are then those of its
    first source by code point). Sources ordered by code point, unknown (NULL) last, weigh
    ``weights`` in turn. ``taken`` = ``size`` times ``epochs``, the whole uses of the document in
    the mix, at most three. A pattern's whole epochs go to all its documents; the rest of its quota
    is filled by documents in an order drawn from the key and ``seed``, in three rounds of ever
    smaller documents that still fit, so at most less than the smallest open document is missing.

    NULL and empty texts have size 0 and are never taken. Rows that repeat a key share a place in
    the order and are taken together or not at all. An empty array counts as an unknown source. An
    empty table gives no rows. Other columns are not read. The same rows and seed give the same
    mix. The driver holds one row for each pattern; beyond ``MAX_PATTERNS`` patterns it raises.
    """
    spark = documents.sparkSession
    staging = Staging(spark)
    many = dict(documents.dtypes)[sources].startswith("array")
    listed = f"CASE WHEN size({sources}) > 0 THEN array_sort(array_distinct({sources})) ELSE array(CAST(NULL AS STRING)) END" if many else f"array(CAST({sources} AS STRING))"
    rows = staging.keep(
        documents.selectExpr(
            f"{key} AS k",
            f"CAST(coalesce(regexp_count({text}, '{WORD_PATTERN}'), 0) AS BIGINT) AS size".replace("\\", "\\\\"),
            f"transform({listed}, s -> coalesce(concat('s', s), 'u')) AS names",
            f"CAST(conv(substr(md5(concat('{seed}:', coalesce(CAST({key} AS STRING), ''))), 1, 15), 16, 10) AS BIGINT) AS ord",
        ).withColumn("pattern", F.expr("array_join(names, '\\u0001')")),
        "rows",
    )
    found = rows.groupBy("pattern").agg(F.sum("size").alias("size"), F.first("names").alias("names"))
    patterns = sorted(found.limit(MAX_PATTERNS + 1).collect(), key=lambda r: r["pattern"])
    if len(patterns) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    # Known sources ('s' + name) by code point, the unknown one ('u') after them; code points order as UTF-8 bytes do.
    names = sorted({n for p in patterns for n in p["names"]}, key=lambda n: (n[0] == "u", n.encode()))
    place = {n: i for i, n in enumerate(names)}
    sizes = [0] * len(names)
    for p in patterns:
        for n in p["names"]:
            sizes[place[n]] += p["size"]
    total = sum(p["size"] for p in patterns)
    shared = water_fill(sizes, [weights[i % len(weights)] for i in range(len(names))]) if names else []
    if sum(sizes) > total:  # overlapping sources: the mix as a whole is as large as the documents
        shared = [x * total / sum(sizes) for x in shared]
    given = route([p["size"] for p in patterns], [[place[n] for n in p["names"]] for p in patterns], [int(x) for x in shared])
    table = [
        (p["pattern"], sizes[place[p["names"][0]]], float(shared[place[p["names"][0]]]), g // p["size"] if p["size"] else 0, g % p["size"] if p["size"] else 0)
        for p, g in zip(patterns, given, strict=True)
    ]
    plan = spark.createDataFrame(table, "pattern string, source_size long, target double, whole long, room long")
    rest, wanted = rows.select("pattern", "size", "ord"), plan.select("pattern", "room")
    chosen: list[str] = []
    for turn in range(FILLS):
        cut = staging.keep(_cut(rest, wanted, turn), f"cut-{turn}")
        plan = plan.join(cut.drop("room"), "pattern", "left")
        chosen.append(f"(size > 0 AND size <= room_{turn} AND ord <= upto_{turn})")
        if turn + 1 < FILLS:
            rest = rest.join(F.broadcast(cut.drop("room")), "pattern", "left").where(f"NOT coalesce({chosen[-1]}, false)").select("pattern", "size", "ord")
            wanted = cut.select("pattern", "room")
    extra = f"CASE WHEN coalesce({' OR '.join(chosen)}, false) THEN 1 ELSE 0 END"
    return (
        rows.join(F.broadcast(plan), "pattern")
        .selectExpr("*", f"CASE WHEN size > 0 THEN least(whole + {extra}, {MAX_EPOCHS}) ELSE 0 END AS epochs")
        .selectExpr(f"k AS {key}", "size", "source_size", "target", "size * epochs AS taken", "CAST(epochs AS INT) AS epochs")
    )


def take(documents: DataFrame, seed: int = 17, key: str = "doc_id") -> DataFrame:
    """The mixed documents themselves: each row as often as the mix takes it, columns unchanged."""
    mixed = mix_sources(documents, seed=seed, key=key).where("epochs > 0")
    mixed = mixed.groupBy(F.col(key).alias("__key")).agg(F.max("epochs").alias("__epochs"))
    rows = documents.select(F.struct("*").alias("__row"), F.col(key).alias("__own"))
    rows = rows.join(mixed, F.col("__own").eqNullSafe(F.col("__key")))
    return rows.select("__row", F.explode(F.expr("sequence(1, __epochs)"))).select("__row.*")
