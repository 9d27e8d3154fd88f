"""Document fingerprints from closed syncmers, in DataFrame expressions only.

A k-mer of tokens is an anchor when the smallest of the hashes of its inner runs of ``s`` tokens is
that of its first or last run. That depends on the k-mer alone, so equal passages have equal anchors
wherever they stand, and every stretch of ``2k - s - 1`` tokens holds at least one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkit.llm.common import hex_sha256, make_room

K, S = 8, 2
# Words of more code points are cut, so that text without blanks has tokens as well.
TOKEN = r"[^\x20\x09-\x0D]{1,16}"
# Blocks of rows per shuffle partition in which neighbours are looked for.
BLOCKS_PER_PARTITION = 16
# Hashes that rows of one id are ordered and dealt by.
_TIES = 1 << 31


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """The closed syncmers of a text, as an array of (``position``, ``hash``) in text order.

    ``position`` counts tokens from 0. A text of one to k - 1 tokens has a single anchor, the hash of all
    of them; null, empty and blank texts have none.
    """
    inner = k - s + 1

    def pick(h: Column) -> Column:
        n = F.size(h)
        runs = h
        if s > 1:
            shifted = [F.slice(h, F.lit(j + 1), F.greatest(n - (s - 1), F.lit(0))) for j in range(s)]
            runs = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: F.xxhash64(x, y)), shifted)

        def chosen(r: Column) -> Column:
            def closed(i: Column) -> Column:
                edge = F.least(F.get(r, i), F.get(r, i + (inner - 1)))
                return F.least(*(F.get(r, i + j) for j in range(1, inner - 1)), edge) == edge

            starts = F.filter(F.sequence(F.lit(0), n - k), closed)
            return F.transform(
                starts, lambda i: F.struct(i.alias("position"), F.xxhash64(F.slice(h, i + 1, F.lit(k))).alias("hash"))
            )

        whole = F.array(F.struct(F.lit(0).alias("position"), F.xxhash64(h).alias("hash")))
        return F.when(n >= k, _let(runs, chosen)).when(n > 0, whole).otherwise(F.slice(whole, 1, 0))

    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))
    return _let(F.transform(tokens, lambda w: F.xxhash64(w)), pick)


def fingerprint(found: Column) -> Column:
    """Anchors as text: the hashes' 16 hex digits each, in text order, joined by blanks."""
    return F.array_join(F.transform(found, lambda a: F.lpad(F.lower(F.hex(a["hash"])), 16, "0")), " ")


def likeness(one: Column, other: Column) -> Column:
    """Share of the distinct anchor hashes of two texts that both have; 1 if neither has any."""
    hashes = [F.transform(x, lambda a: a["hash"]) for x in (one, other)]
    both, all_ = F.size(F.array_intersect(*hashes)), F.size(F.array_union(*hashes))
    return F.when(all_ == 0, F.lit(1.0)).otherwise(both / all_)


def shared_anchors(one: Column, other: Column) -> Column:
    """Positional matches: (position in one, position in other) of the anchors both have, in order."""
    pairs = F.transform(
        one,
        lambda a: F.transform(
            F.filter(other, lambda b: b["hash"] == a["hash"]),
            lambda b: F.struct(a["position"].alias("one"), b["position"].alias("other")),
        ),
    )
    return F.flatten(pairs)


def with_anchors(df: DataFrame, text: str = "text", name: str = "anchors", k: int = K, s: int = S) -> DataFrame:
    """Add the anchors of a text column. Rows are independent; a column called ``name`` already is replaced."""
    return make_room(df, name).withColumn(name, anchors(F.col(text), k, s))


def _constants(values: list, kind: str) -> Column:
    """Numbers as one constant array, so that a plan does not grow with them."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _not_above(value: Column, cuts: Column, n: int) -> Column:
    """How many of ``n`` ascending ``cuts`` are not above a value, by halving."""
    steps = [1 << i for i in reversed(range(n.bit_length()))]
    at = lambda place, step: F.when(F.get(cuts, place + step - 1) <= value, place + step).otherwise(place)
    return F.aggregate(_constants(steps, "int"), F.lit(0), at)


def beside_next(df: DataFrame, row_id: str, *columns: str, add=None) -> DataFrame:
    """Every row with ``columns`` of the next row by ascending integer id, as ``next_...``.

    The last row gets the first. Null ids come first; rows of one id, nulls too, are ordered by a hash of
    ``columns`` and then by them, so that repeated rows follow each other and a frequent id is dealt out
    as well; only whole repeated rows meet in one task. The rows are dealt once, into blocks of
    neighbours whose bounds are quantiles; the first row of each block goes to the block before as well.
    ``add`` derives columns after that shuffle; name them in ``columns`` to get them from the next row too.
    """
    spark = df.sparkSession
    n = BLOCKS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c) for c in df.columns if c in columns]
    mark = F.xxhash64(*order).bitwiseAND(F.lit(_TIES - 1))
    key = F.col(row_id).cast("long")
    least = df.agg(F.min(key)).first()[0] or 0
    # doubles may round, but never out of order
    at = F.coalesce(key.cast("double") - F.lit(float(least)) + 1, F.lit(0.0)) * _TIES
    wanted = ",".join(str(i / n) for i in range(1, n))

    def quantiles(place: Column) -> list[float]:
        found = F.expr(f"percentile_approx(__at, cast(split('{wanted}', ',') as array<double>), {20 * n})")
        return df.select(place.alias("__at")).agg(found.alias("q")).first()["q"] or []

    cuts, tie = quantiles(at), F.lit(0).cast("long")
    if len(set(cuts)) < len(cuts):  # an id with more rows than a block: only then are the columns read for it
        tie = mark
        cuts = quantiles(at + tie)
    cuts = sorted(set(cuts))
    rows = df.withColumn("__key", key).withColumn("__tie", tie)
    block = _not_above(at + F.col("__tie"), _constants(cuts, "double"), len(cuts)) if cuts else F.lit(0)
    rows = rows.withColumn("__block", block)
    first = F.min(F.struct("__key", "__tie"))
    # one small row per block, at most n; structs compare with null first
    heads = sorted(rows.groupBy("__block").agg(first.alias("head")).collect())
    before = {h["__block"]: heads[i - 1]["__block"] for i, h in enumerate(heads)}
    head = {h["__block"]: h["head"] for h in heads}
    numbers = range(len(cuts) + 1)
    of = lambda values, kind: F.get(_constants(values, kind), F.col("__block"))
    # a block without rows is never looked up; the null id is told by its place
    is_head = (F.col("__tie") == of([head[b]["__tie"] if b in head else -1 for b in numbers], "bigint")) & F.coalesce(
        F.col("__key") == of([(head[b]["__key"] or 0) if b in head else 0 for b in numbers], "bigint"), F.lit(True)
    )
    null_head = of([int(b in head and head[b]["__key"] is None) for b in numbers], "int") == 1
    is_head = is_head & (F.col("__key").isNull() == null_head)
    to = F.when(is_head, of([before.get(b, 0) for b in numbers], "int"))
    own = F.struct(F.col("__block").alias("block"), F.lit(False).alias("copy"))
    copy = F.struct(to.alias("block"), F.lit(True).alias("copy"))
    rows = rows.withColumn("__place", F.explode(F.when(to.isNull(), F.array(own)).otherwise(F.array(own, copy)))).select(
        *df.columns, "__key", "__tie", F.col("__place.block").alias("__block"), F.col("__place.copy").alias("__copy")
    )
    rows = rows.repartition("__block")
    rows = add(rows) if add else rows
    w = Window.partitionBy("__block").orderBy("__copy", "__key", mark, *order)
    following = [F.lead(c).over(w).alias(f"next_{c}") for c in columns]
    return rows.select("*", *following).filter(~F.col("__copy")).drop("__key", "__tie", "__block", "__copy")


def compare_with_edits(df: DataFrame, row_id: str = "doc_id", text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """Fingerprints of every text and of the text with its second half taken from the next document.

    Returns the id, ``n_chars``, ``edited`` (text), ``anchors``, ``edited_anchors``, ``near_edited`` and
    ``near_next``. The last floor(n_chars / 2) code points are replaced by the first as many of the next
    document by ascending id, or by all of it; a null text counts as empty. A single row is its own next.
    Rows of one id are ordered by a hash of the text, copies thus in a row; null ids come first. Texts of any
    length are taken whole; only the id and the text of ``df`` are read. An empty table gives an empty result.
    """
    docs = df.select(F.col(row_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = beside_next(docs, "id", "text", "anchors", add=lambda d: d.withColumn("anchors", anchors(F.col("text"), k, s)))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("*", n.cast("long").alias("n_chars"), edited.alias("edited"))
    rows = rows.withColumn("edited_anchors", anchors(F.col("edited"), k, s))
    return rows.select(
        F.col("id").alias(row_id),
        "n_chars",
        "edited",
        "anchors",
        "edited_anchors",
        likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"),
    )


def digest_columns(found: DataFrame, row_id: str = "doc_id") -> DataFrame:
    return found.select(
        row_id,
        "n_chars",
        hex_sha256(F.col("edited")).alias("edited_sha256"),
        fingerprint(F.col("anchors")).alias("fingerprint"),
        fingerprint(F.col("edited_anchors")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
