"""Personal data as spans, by rules and by boosted trees over proposed spans, in DataFrame expressions.

The rules (e-mail, IP address, card, phone) find base spans. Wider patterns propose candidates, which
may overlap. Candidates that a rule accepts are positives; those that another rule accepts, whose
format rules the kind out or whose check digit is wrong are negatives; the others are undecided. Trees boosted on the decided ones, from
format and context alone (not the check digit, not the plus sign), score the undecided ones, and a
threshold per kind, calibrated for precision on a held-out half, selects what joins the base spans.
The trees are compiled into expressions, so texts are scanned in place and never shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.llm.common import fresh, make_room
from tabkit.runtime import materialize, persisted

KINDS = ("email", "ip", "card", "phone")
TREES, DEPTH = 12, 3
# Bins of a feature, more if that leaves MLlib less than all rows to take its thresholds from.
BINS = 1024
PRECISION = 0.95

_LOCAL = "[A-Za-z0-9._%+-]"
# The rules, written so that no match is retried within a run and no group recurses.
_RULES = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT = r"(?:@|\x20?[\[(]at[\])]\x20?|\x20at\x20)"
_DOT = r"(?:\.|\x20?[\[(]dot[\])]\x20?|\x20dot\x20)"
_PROPOSED = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f.:])[0-9A-Fa-f]{1,4}(?:[.:][0-9A-Fa-f]{1,4}){3,7}+",
    "number": r"(?<![0-9])[+(]?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+",
}
# Every text with a candidate has this: parts that the patterns above cannot do without.
_SOME = rf"[0-9]|{_LOCAL}{_AT}[A-Za-z0-9-]++{_DOT}[A-Za-z0-9-]|(?:[.:][0-9A-Fa-f]{{1,4}}){{3}}"
_CONTEXT = 24
_CUE = r"(?i)(?:call|tel|phone|fax|mail|card|visa|account|addr|address|ip|contact)[:.]?\s*$"
FEATURES = (
    "kind", "length", "digits", "letters", "others", "dots", "groups", "longest", "lead", "open_left", "open_right", "cue"
)


def _prefix_sums(lengths: Column, chunk: int = 64) -> Column:
    """Sum of the numbers before each place, in two levels so that long lists cost little."""
    total = lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x)
    zero = F.lit(0)

    def outer(n: Column) -> Column:
        parts = F.ceil(F.size(n) / chunk).cast("int")
        sums = F.transform(F.sequence(zero, parts - 1), lambda j: total(F.slice(n, j * chunk + 1, F.lit(chunk))))
        before = F.transform(F.array(sums), lambda s: F.transform(F.sequence(zero, F.size(s) - 1), lambda j: total(F.slice(s, F.lit(1), j))))[0]
        return F.transform(
            F.array(before),
            lambda b: F.transform(
                F.sequence(zero, F.size(n) - 1),
                lambda i: F.get(b, F.floor(i / chunk).cast("int"))
                + total(F.slice(n, F.floor(i / chunk).cast("int") * chunk + 1, i % chunk)),
            ),
        )[0]

    return F.transform(F.array(lengths), outer)[0]


def matches(text: Column, pattern: str) -> Column:
    """All matches of a pattern as an array of (``start``, ``end``, ``span``), in code points."""

    def places(found: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda g: F.char_length(g))
        sizes = F.transform(found, lambda m: F.char_length(m))
        steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), sizes, lambda g, m: g + m)

        def spans(s: Column) -> Column:
            return F.transform(
                F.arrays_zip(s.alias("s"), _prefix_sums(s).alias("p"), found.alias("m")),
                lambda z: F.struct(
                    (z["p"] + z["s"] - F.char_length(z["m"])).alias("start"), (z["p"] + z["s"]).alias("end"), z["m"].alias("span")
                ),
            )

        return F.transform(F.array(steps), spans)[0]

    none = F.array().cast("array<struct<start:int,end:int,span:string>>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.transform(F.array(found), lambda f: F.when(F.size(f) > 0, places(f)).otherwise(none))[0]


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def _accepted(kind: str, span: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        parts = F.transform(F.split(span, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (F.char_length(p) < 3) | ((F.char_length(p) == 3) & (p <= "255")))
    n = F.char_length(_digits(span))
    if kind == "card":
        return n.between(16, 19) & F.call_function("luhn_check", _digits(span))
    return n.between(8, 15)


def _tagged(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda m: F.struct(F.lit(KINDS.index(kind)).alias("kind"), m["start"], m["end"], m["span"]))


_SPANS = "array<struct<kind:int,start:int,end:int,span:string>>"


def base_spans(text: Column) -> Column:
    """What the rules accept, ordered by kind and start: array of (kind number, start, end, span)."""
    out = []
    for kind in KINDS:
        accept = partial(_accepted, kind)
        found = F.filter(matches(text, _RULES[kind]), lambda m: accept(m["span"]))  # noqa: B023
        sign = {"email": "@", "phone": "+"}.get(kind)
        if sign:  # most texts have none
            found = F.when(F.contains(text, F.lit(sign)), found).otherwise(F.array())
        out.append(_tagged(kind, found).cast(_SPANS))
    return F.concat(*out)


def proposed_spans(text: Column) -> Column:
    """Candidates with their features: array of (kind, start, end, span, before, after)."""
    number = matches(text, _PROPOSED["number"])
    found = F.concat(
        _tagged("email", matches(text, _PROPOSED["email"])).cast(_SPANS),
        _tagged("ip", matches(text, _PROPOSED["ip"])).cast(_SPANS),
        _tagged("card", number).cast(_SPANS),
        _tagged("phone", number).cast(_SPANS),
    )
    return F.transform(
        found,
        lambda c: F.struct(
            c["kind"],
            c["start"],
            c["end"],
            c["span"],
            F.substring(text, F.greatest(c["start"] - _CONTEXT, F.lit(0)) + 1, F.least(c["start"], F.lit(_CONTEXT))).alias("before"),
            F.substring(text, c["end"] + 1, F.lit(1)).alias("after"),
        ),
    )


def features(c: Column) -> dict[str, Column]:
    """What the trees see of a candidate."""
    span = F.ltrim(c["span"], F.lit("+"))
    digits = F.char_length(_digits(span))
    letters = F.char_length(F.regexp_replace(span, "[^A-Za-z]", ""))
    groups = F.split(F.trim(F.regexp_replace(span, "[^0-9]+", " ")), " ")
    out = {
        "kind": c["kind"],
        "length": F.char_length(span),
        "digits": digits,
        "letters": letters,
        "others": F.char_length(span) - digits - letters,
        "dots": F.char_length(F.regexp_replace(span, "[^.]", "")),
        "groups": F.size(groups),
        "longest": F.array_max(F.transform(groups, lambda g: F.char_length(g))),
        "lead": F.coalesce(F.substring(_digits(span), 1, 1).try_cast("int"), F.lit(-1)),
        "open_left": c["before"].rlike(r"(?:^|[\s(<\[\"':=,;])$"),
        "open_right": c["after"].rlike(r"^(?:$|[\s)>\]\"'.,;:!?])"),
        "cue": c["before"].rlike(_CUE),
    }
    return {n: out[n].cast("double") for n in FEATURES}


def _possible(c: Column) -> Column:
    """Whether the format leaves the kind open."""
    n = F.char_length(_digits(c["span"]))
    octets = F.forall(F.split(c["span"], "[.:]"), lambda p: F.char_length(p).between(1, 4))
    return (
        F.when(c["kind"] == 0, F.lit(True))
        .when(c["kind"] == 1, octets & (F.size(F.split(c["span"], "[.:]")).isin(4, 8)))
        .when(c["kind"] == 2, n.between(13, 19))
        .otherwise(n.between(8, 15))
    )


def _unchecked(c: Column) -> Column:
    """A card number of full length whose check digit is wrong."""
    digits = _digits(c["span"])
    return (c["kind"] == 2) & F.char_length(digits).between(16, 19) & ~F.call_function("luhn_check", digits)


def _label(c: Column, base: Column) -> Column:
    """1 accepted by its rule, 0 accepted by another, impossible or with a wrong check digit, null undecided."""
    same = F.exists(base, lambda b: (b["kind"] == c["kind"]) & (b["start"] == c["start"]) & (b["end"] == c["end"]))
    other = F.exists(base, lambda b: (b["kind"] != c["kind"]) & (b["start"] < c["end"]) & (c["start"] < b["end"]))
    return F.when(same, 1.0).when(other | ~_possible(c) | _unchecked(c), 0.0)


@dataclass
class Trees:
    """Boosted trees as nested (feature, threshold, left, right) or numbers, and a threshold per kind."""

    trees: list = field(default_factory=list)
    thresholds: dict[int, float] = field(default_factory=dict)

    def score(self, f: dict[str, Column]) -> Column:
        """Probability of a candidate with the features ``f``."""

        def walk(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            at, threshold, left, right = node
            return F.when(f[FEATURES[at]] <= threshold, walk(left)).otherwise(walk(right))

        margin = reduce(lambda a, b: a + b, map(walk, self.trees), F.lit(0.0))
        return 1 / (1 + F.exp(-2 * margin))


def _nodes(node, weight: float):
    if node.getClass().getSimpleName() == "LeafNode":
        return float(node.prediction()) * weight
    split = node.split()
    return (split.featureIndex(), float(split.threshold()), _nodes(node.leftChild(), weight), _nodes(node.rightChild(), weight))


def decided(df: DataFrame, text: str = "text") -> DataFrame:
    """All decided candidates by their features, label and half: (features, label, even, n).

    The half is that of the hash of span, place and kind, so copies of a candidate share one.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    docs = df.select(body.alias("text")).filter(F.col("text").rlike(_SOME))
    found = docs.select(base_spans(F.col("text")).alias("base"), proposed_spans(F.col("text")).alias("found"))
    rows = found.select("base", F.explode("found").alias("c"))
    rows = rows.select("c", _label(F.col("c"), F.col("base")).alias("label")).filter("label IS NOT NULL")
    even = F.pmod(F.xxhash64("c.span", "c.before", "c.kind", "c.start"), F.lit(2)) == 0
    rows = rows.select(even.alias("even"), "label", *(x.alias(n) for n, x in features(F.col("c")).items()))
    return rows.groupBy("even", "label", *FEATURES).agg(F.count("*").cast("double").alias("n"))


def fit(df: DataFrame, text: str = "text", precision: float = PRECISION) -> Trees:
    """Fit and calibrate on all decided candidates, those of equal features as one row with their number as weight.

    Half of them, by hash, fit the trees; the other half sets, per kind, the lowest threshold at which the
    share of positives reaches ``precision``. A kind without enough candidates gets none, and without
    both classes there are no trees; then only base spans are returned.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    # in one order, so that sums of weights are the same for every partitioning
    rows = materialize(decided(df, text).orderBy("even", "label", *FEATURES), "personal-candidates")
    halves = {r["even"]: r for r in rows.groupBy("even").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("rows")).collect()}
    if len(halves) < 2 or halves[True]["low"] == halves[True]["high"]:
        return Trees()
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows).select("even", "kind", "label", "n", "features")
    # MLlib looks for thresholds in bins ** 2 rows: in all of them
    bins = max(BINS, math.isqrt(halves[True]["rows"]) + 1)
    trainer = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=bins, weightCol="n", seed=1)
    with persisted(vectors.filter("even")) as kept:
        model = trainer.fit(kept)
    trees = [_nodes(t._call_java("rootNode"), w) for t, w in zip(model.trees, model.treeWeights, strict=True)]

    held = model.transform(vectors.filter("NOT even")).select("kind", "label", "n", vector_to_array("probability")[1].alias("p"))
    bins = held.groupBy("kind", F.floor(F.col("p") * 50).cast("int").alias("bin")).agg(
        F.sum(F.col("label") * F.col("n")).alias("good"), F.sum("n").alias("n")
    )
    counts: dict[int, list] = {}
    for r in bins.collect():  # 51 bins for each of four kinds
        counts.setdefault(int(r["kind"]), []).append((r["bin"], r["good"], r["n"]))
    thresholds = {}
    for kind, rows_ in counts.items():
        good = n = 0
        best = math.inf
        for at, g, m in sorted(rows_, reverse=True):
            good, n = good + g, n + m
            if good >= precision * n and good > 0:
                best = at / 50
        if best < math.inf:
            thresholds[kind] = max(best, 0.5)
    return Trees(trees, thresholds)


def added_spans(text: Column, base: Column, trees: Trees) -> Column:
    """Undecided candidates that reach their kind's threshold and overlap no base span."""
    if not trees.trees or not trees.thresholds:
        return F.array().cast(_SPANS)

    def limit(c: Column) -> Column:
        out = F.lit(math.inf)
        for kind, threshold in trees.thresholds.items():
            out = F.when(c["kind"] == kind, threshold).otherwise(out)
        return out

    open_ = F.filter(proposed_spans(text), lambda c: _possible(c) & ~_unchecked(c) & ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    seen = F.transform(open_, lambda c: F.struct(c.alias("c"), *(x.alias(n) for n, x in features(c).items())))
    good = F.filter(seen, lambda s: trees.score({n: s[n] for n in FEATURES}) >= limit(s["c"]))
    return F.transform(good, lambda s: F.struct(s["c"]["kind"], s["c"]["start"], s["c"]["end"], s["c"]["span"])).cast(_SPANS)


def find_personal(df: DataFrame, text: str = "text", trees: Trees | None = None, prefix: str = "") -> DataFrame:
    """Add ``base`` and ``spans``, arrays of (``kind`` number, ``start``, ``end``, ``span``) in code points.

    ``base`` is what the rules find, ``spans`` that and the candidates the trees select, both ordered by
    kind and start. Null texts are empty. Trees are fitted on ``df`` unless given. Rows are
    independent: repeated rows and ties need no special case, and all columns stay but those
    called like the new ones.
    """
    names = (prefix + "base", prefix + "spans")
    df = make_room(df, *names)
    trees = fit(df, text) if trees is None else trees
    body = F.coalesce(F.col(text), F.lit(""))
    out = df.withColumn(names[0], base_spans(body))
    some = body.rlike(_SOME)
    more = F.when(some, added_spans(body, F.col(names[0]), trees)).otherwise(F.array().cast(_SPANS))
    return out.withColumn(names[1], F.array_sort(F.concat(F.col(names[0]), more)))


def as_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(df: DataFrame, text: str = "text", trees: Trees | None = None) -> DataFrame:
    """The same columns, each span of the text replaced by its kind in angle brackets.

    Where spans overlap, the first by start and the longest of those wins. Texts without spans, null
    ones included, stay as they are.
    """
    prefix = fresh(df, "found_")
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix = "_" + prefix
    found = find_personal(df, text, trees, prefix)
    spans, body = F.col(prefix + "spans"), F.col(text)
    kinds = F.array(*map(F.lit, KINDS))
    placed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("last"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    step = lambda a, s: F.when(s["start"] < a["at"], a).otherwise(
        F.struct(
            (-s["last"]).alias("at"),
            F.concat(
                a["parts"],
                F.array(F.substring(body, a["at"] + 1, s["start"] - a["at"]), F.concat(F.lit("<"), F.get(kinds, s["kind"]), F.lit(">"))),
            ).alias("parts"),
        )
    )
    end = lambda a: F.concat(F.array_join(a["parts"], ""), F.substring(body, a["at"] + 1, F.char_length(body)))
    clean = F.when(F.size(spans) > 0, F.aggregate(placed, start, step, end)).otherwise(body)
    return found.withColumn(text, clean).select(*df.columns)
