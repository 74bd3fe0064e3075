"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A document is the weighted set of its words (weight: how often the word occurs). For each place of
the fingerprint every word draws r and c from Gamma(2, 1) and b from U(0, 1), all from its hash, and
offers  c / (y e^r)  with  y = exp(r (floor(ln w / r + b) - b)).  The word with the least offer is
the sample, together with the step floor(ln w / r + b). Two documents have the same sample with a
probability equal to the generalised Jaccard similarity sum(min(w, v)) / sum(max(w, v)).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Staging, text_words

#: Samples of a fingerprint; the likeness has a standard deviation of at most 1 / (2 sqrt(PLACES)).
PLACES = 64
#: Bits of a sample that a fingerprint keeps: two different samples agree in them with probability 2**-31.
HEX_DIGITS = 8
#: Longest run of keys that one task orders, as rows expected.
SLICE_ROWS = 50_000


def _uniform(word: str, shift: int, bits: int) -> str:
    """SQL for a number in (0, 1) from some bits of a hash."""
    return f"(((({word} >> {shift}) & {(1 << bits) - 1}L) + 0.5D) * {2.0**-bits!r}D)"


def packed_offer(place: int) -> str:
    """SQL that packs a word's offer for one place with its sample (``h``: the word's hash, ``lw``: ln of its weight).

    The upper half orders as ln c - r (step - b) - r does, the logarithm of the offer; the lower half
    identifies word and step. The least packed number carries the sample. One hash of word and place
    gives all numbers drawn: ten bits for each factor of r, twelve for b, sixteen for each factor of c.
    """
    drawn = f"xxhash64(h, {place})"
    r = f"(-ln({_uniform(drawn, 0, 10)} * {_uniform(drawn, 10, 10)}))"
    b = _uniform(drawn, 20, 12)
    log_c = f"ln(-ln({_uniform(drawn, 32, 16)} * {_uniform(drawn, 48, 16)}))"
    step = f"floor(lw / {r} + {b})"
    offer = f"CAST(({log_c} - {r} * ({step} - {b} + 1D) + 1000D) * 1048576D AS BIGINT)"
    return f"(({offer} << 32) | (({drawn} ^ ({step} * 2654435761L)) & 2147483647L))"


def least_offers(weighted: DataFrame, by: list[str]) -> DataFrame:
    """``(*by, offers)``: the least packed offer for each place among rows ``(*by, h, w)``, words with their weights."""
    rows = weighted.selectExpr(*by, "h", "ln(CAST(w AS DOUBLE)) AS lw")
    least = rows.groupBy(*by).agg(*[F.expr(f"min({packed_offer(i)})").alias(f"m{i}") for i in range(PLACES)])
    return least.select(*by, F.array(*[f"m{i}" for i in range(PLACES)]).alias("offers"))


def _samples(offers: str) -> str:
    """SQL for the samples that packed offers carry."""
    return f"transform({offers}, m -> CAST(m & 2147483647L AS INT))"


def fingerprints(rows: DataFrame, by: list[str], text: str) -> DataFrame:
    """``(*by, samples)`` for each row of ``rows`` whose text has words; ``by`` identifies a row.

    If ``rows`` is already partitioned by (some of) ``by``, nothing is shuffled.
    """
    words = rows.select(*by, F.explode(F.expr(text_words(text))).alias("word")).select(*by, F.expr("xxhash64(word)").alias("h"))
    weighted = words.groupBy(*by, "h").agg(F.count(F.lit(1)).alias("w"))
    return least_offers(weighted, by).select(*by, F.expr(_samples("offers")).alias("samples"))


#: Versions of a text that has been edited, and what both have in common.
OWN, EDITED, SHARED = 0, 1, 2


def edit_fingerprints(pairs: DataFrame, by: list[str], own: str, edited: str, same: str) -> DataFrame:
    """``(*by, own, edited)``: samples of two versions of a text whose first ``same`` characters are equal.

    Only words whose weight differs are drawn for each version; the others are drawn once and count for
    both. A version without words has no samples (NULL); without any word in both there is no row.
    If ``pairs`` is already partitioned by (some of) ``by``, nothing is shuffled.
    """
    spaces = "concat(chr(9), chr(10), chr(11), chr(12), chr(13))"
    last = f"instr(reverse(translate(left({own}, {same}), {spaces}, '     ')), ' ')"
    cut = pairs.select(*by, F.expr(own).alias("own"), F.expr(edited).alias("edited"), F.expr(f"IF({last} = 0, 0, {same} - {last} + 1)").alias("cut"))
    parts = f"map({OWN}, substring(own, cut + 1), {EDITED}, substring(edited, cut + 1), {SHARED}, left(own, cut))"
    words = cut.select(*by, F.explode(F.expr(parts)).alias("version", "part"))
    words = words.select(*by, "version", F.explode(F.expr(text_words("part"))).alias("word")).selectExpr(*by, "version", "xxhash64(word) AS h")
    counted = words.groupBy(*by, "h").agg(F.expr(f"count_if(version != {EDITED})").alias("w0"), F.expr(f"count_if(version != {OWN})").alias("w1"))
    each = [f"named_struct('version', {v}, 'w', {w})" for v, w in ((OWN, "w0"), (EDITED, "w1"), (SHARED, "w0"))]
    drawn = (
        f"CASE WHEN w0 = w1 THEN array({each[SHARED]}) WHEN w0 = 0 THEN array({each[EDITED]}) "
        f"WHEN w1 = 0 THEN array({each[OWN]}) ELSE array({each[OWN]}, {each[EDITED]}) END"
    )
    weighted = counted.select(*by, "h", F.explode(F.expr(drawn)).alias("d")).select(*by, "h", "d.version", "d.w")
    least = least_offers(weighted, [*by, "version"]).groupBy(*by).agg(F.expr("collect_list(struct(version, offers))").alias("found"))

    def merged(other: int) -> str:
        fewer = "IF(s IS NULL, x.offers, zip_with(s, x.offers, (a, b) -> least(a, b)))"
        return _samples(f"aggregate(filter(found, x -> x.version != {other}), CAST(NULL AS ARRAY<BIGINT>), (s, x) -> {fewer})")

    return least.selectExpr(*by, f"{merged(EDITED)} AS own", f"{merged(OWN)} AS edited")


def likeness(a: str, b: str) -> Column:
    """Share of places with equal samples; 1 for two texts without words, 0 if only one has none."""
    same = f"aggregate(zip_with({a}, {b}, (x, y) -> IF(x = y, 1, 0)), 0, (s, x) -> s + x) / {PLACES}D"
    return F.expr(f"CASE WHEN {a} IS NULL AND {b} IS NULL THEN 1D WHEN {a} IS NULL OR {b} IS NULL THEN 0D ELSE {same} END")


def as_text(samples: str) -> Column:
    """A fingerprint as text: its samples in hexadecimal; empty for a text without words."""
    return F.expr(f"coalesce(array_join(transform({samples}, x -> lpad(lower(hex(x)), {HEX_DIGITS}, '0')), ''), '')")


def successors(keys: DataFrame, staging: Staging) -> DataFrame:
    """``(o, t, no, nt)``: the key after each distinct key ``(o, t)`` in descending order, the first after the last.

    Keys are cut into ranges; only a range's keys are ordered in one task. A range's last key is
    followed by the first key of the next range, from a table with one row a range.
    """
    ranges = max(1, -(-keys.count() // SLICE_ROWS))
    ranged = keys.repartitionByRange(ranges, F.desc("o"), F.desc("t")).withColumn("slice", F.spark_partition_id())
    ranged = staging.keep(ranged, "ranged")  # stored, so that every reader sees the same ranges
    inside = ranged.selectExpr(
        "o", "t", "slice", "lead(named_struct('o', o, 't', t)) OVER (PARTITION BY slice ORDER BY o DESC, t DESC) AS next"
    )
    heads = ranged.groupBy("slice").agg(F.expr("max(named_struct('o', o, 't', t))").alias("head"))
    heads = staging.keep(heads, "heads")
    after = heads.selectExpr(
        "slice", "coalesce(lead(head) OVER (ORDER BY slice), first(head) OVER (ORDER BY slice)) AS after"
    )
    return inside.join(after, "slice").selectExpr("o", "t", "coalesce(next, after).o AS no", "coalesce(next, after).t AS nt")


def compare_edits(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of an edited version, and their likenesses.

    The edited text has its last third (floor(n / 3) code points) replaced by the first as many (or
    all) of the next text in descending order of the key, after the last that of the first. Returns
    ``(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``.

    A NULL text counts as empty. A text without words has the empty fingerprint, which is like
    itself only. NULL keys come last in the order; rows that share a key follow each other by the
    hash of their texts, and rows equal in both are one document, reported as often as they occur. A
    single document is its own successor. An empty table gives no rows. Other columns are not read.
    """
    staging = Staging(documents.sparkSession)
    body = f"coalesce({text}, '')"
    rows = documents.selectExpr(
        f"{key} AS k", f"coalesce(CAST({key} AS BIGINT), CAST('-9223372036854775808' AS BIGINT)) AS o", f"xxhash64({body}) AS t", f"{body} AS body"
    )
    listed = staging.keep(rows.selectExpr("k", "o", "t", "CAST(length(body) AS BIGINT) AS n"), "listed")
    follow = staging.keep(successors(listed.select("o", "t").distinct(), staging), "follow")
    staging.drop("ranged")
    bodies = rows.select("o", "t", "body").dropDuplicates(["o", "t"])
    asked = follow.join(listed.select("o", "t", "n").distinct(), ["o", "t"]).selectExpr("no", "nt", "o AS fo", "t AS ft", "CAST(floor(n / 3) AS INT) AS third")
    starts = bodies.join(asked, (bodies["o"] == asked["no"]) & (bodies["t"] == asked["nt"])).selectExpr(
        "fo AS o", "ft AS t", "third", "no", "nt", "substring(body, 1, third) AS start"
    )
    both = bodies.join(starts, ["o", "t"]).selectExpr("o", "t", "no", "nt", "body", "length(body) - third AS same", "concat(left(body, length(body) - third), start) AS edited")
    digests = both.selectExpr("o", "t", "no", "nt", "sha2(CAST(edited AS BINARY), 256) AS edited_sha256")
    prints = edit_fingerprints(both, ["o", "t"], "body", "edited", "same")
    # Of the edited text's samples only those that are not its own are stored.
    changed = "zip_with(edited, coalesce(own, array()), (e, w) -> IF(e = w, NULL, e)) AS changed"
    stored = staging.keep(digests.join(prints, ["o", "t"], "left").selectExpr("o", "t", "no", "nt", "edited_sha256", "own", changed), "prints")
    after = stored.selectExpr("o AS no", "t AS nt", "own AS after")
    next_ones = stored.select("o", "t", "no", "nt", "own").join(after, ["no", "nt"]).select("o", "t", likeness("own", "after").alias("near_next"))
    out = listed.join(stored.select("o", "t", "edited_sha256", "own", "changed"), ["o", "t"]).join(next_ones, ["o", "t"])
    out = out.withColumn("edited", F.expr("zip_with(changed, coalesce(own, array()), (c, w) -> coalesce(c, w))"))
    return out.select(
        F.col("k").alias(key),
        F.col("n").alias("n_chars"),
        "edited_sha256",
        as_text("own").alias("fingerprint"),
        as_text("edited").alias("edited_fingerprint"),
        likeness("own", "edited").alias("near_edited"),
        "near_next",
    )
