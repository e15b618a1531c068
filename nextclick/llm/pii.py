"""Personal data: generators propose spans, boosted trees score them, calibrated thresholds select.

Everything on the way is a column expression: matches come from
``regexp_extract_all``, their places from the lengths of what ``split`` leaves
between them. Per kind the *base* generator's spans that pass its check are
always selected. Further generators propose spans the base patterns miss (a
card or a phone inside a longer run of digits, written-out addresses). Trees
are boosted on the base generators' candidates, labelled by whether the check
held, over format and context features without the check itself; a further
span is selected if it passes the check, its score reaches its kind's
threshold and it overlaps no base span.

The training table is the candidates of all documents summed up by feature
values ("cells"; at most the product of the feature ranges, whatever the input), so
nothing is sampled and the model needs no row of text.

Defined cases: a null or empty text has no spans; a text of any length is read whole, and what surrounds a hit is cut
from a block of the text, so the work does not grow with hits times length; an empty table has no rows; repeated rows and null ids
are treated row by row; with candidates of one label only no trees are grown and the
base spans alone are selected; other columns are ignored, or kept as they are by the stage.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nextclick.llm.common import let, materialise, null_to_empty, read, running_totals

KINDS = ["email", "ip", "card", "phone"]

#: Base patterns. Possessive and anchored forms of the plain ones: same matches, without retries inside a run.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: Further generators: what the base patterns run past or do not know.
MORE = [
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[({](?:at|AT)[\])}]\x20?[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[({](?:dot|DOT)[\])}]\x20?)[A-Za-z0-9-]{1,63})+"),
    ("ip", r"(?<![0-9])(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{4}([\x20-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])"),
    ("phone", r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{4}(?![0-9])"),
    ("phone", r"(?<![0-9+)-])\([0-9]{3}\)\x20?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
]

#: A text without these has no match of the kind.
_NEEDS = {"email": r"@|(?i)[\[({]at[\])}]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9]", "phone": r"[+(][0-9]"}

_CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|contact|write|correo|courriel)\b", "ip": r"(?i)\b(?:ip|host|server|address|adresse)\b",
    "card": r"(?i)\b(?:card|visa|credit|karte|carte|tarjeta)\b", "phone": r"(?i)\b(?:tel|phone|call|fax|mobile|telefon)\b",
}
_COUNTING = r"(?i)(?:\b(?:order|id|no|nr|number|version|isbn|ref)\b|#|\bv)[\x20.:=]*$"

FEATURES = ["kind", "before", "after", "digits", "separator", "lead", "context"]


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, hit>> of the leftmost non-overlapping matches, in code points, end exclusive."""
    def placed(found: Column) -> Column:
        hits, between = found["hits"], found["between"]
        steps = F.transform(hits, lambda h, i: F.length(F.element_at(between, i + 1)) + F.length(h))
        return let(running_totals(steps), lambda before: F.transform(hits, lambda h, i: let(
            F.element_at(before, i + 1) + F.length(F.element_at(between, i + 1)),
            lambda start: F.struct(start.alias("start"), (start + F.length(h)).alias("end"), h.alias("hit")))))

    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"), F.split(text, pattern, -1).alias("between"))
    return let(found, placed)


def passes(kind: str, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "ip":
        return ~hit.rlike(r"(?:^|\.)0*(?:[1-9][0-9]{3,}|[3-9][0-9]{2}|2[6-9][0-9]|25[6-9])(?:\.|$)")
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


#: Code points of a block of text.
BLOCK = 256


def blocks(text: Column) -> Column:
    """The text in blocks of ``BLOCK`` code points: a place is found from its block, not counted from the start of a long text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def cut(parts: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` (exclusive) of a text in blocks."""
    first = F.floor(start / BLOCK).cast("int")
    near = F.array_join(F.slice(parts, first + 1, F.floor(end / BLOCK).cast("int") - first + 1), "")
    return F.substr(near, start - first * BLOCK + 1, end - start)


def _side(char: Column) -> Column:
    return (F.when(char == "", 0).when(char.rlike(r"^\s"), 1).when(char.rlike(r"^[0-9]"), 4).when(char.rlike(r"^\p{L}"), 3).otherwise(2))


def _candidate(kind: str, parts: Column, at: Column, base: bool) -> Column:
    """Span, its check, and its cell: the feature values joined by commas."""
    hit, before = at["hit"], cut(parts, F.greatest(at["start"] - 24, F.lit(0)), at["start"])
    marks = F.regexp_replace(hit, r"[^\x20.()-]", "")
    values = [
        F.lit(KINDS.index(kind)),
        _side(cut(parts, F.greatest(at["start"] - 1, F.lit(0)), at["start"])),
        _side(cut(parts, at["end"], at["end"] + 1)),
        F.least(F.length(F.regexp_replace(hit, "[^0-9]", "")), F.lit(20)),
        F.when(marks == "", 0).when(marks.rlike(r"^\x20+$"), 1).when(marks.rlike(r"^-+$"), 2).when(marks.rlike(r"^\.+$"), 3).otherwise(4),
        F.coalesce(F.regexp_extract(hit, r"([0-9])", 1).try_cast("int"), F.lit(10)),
        F.when(before.rlike(_CONTEXT[kind]), 1).when(before.rlike(_COUNTING), 2).otherwise(0),
    ]
    return F.struct(F.lit(KINDS.index(kind)).alias("kind"), at["start"].alias("start"), at["end"].alias("end"),
                    passes(kind, hit).alias("ok"), F.lit(base).alias("base"), F.concat_ws(",", *[v.cast("string") for v in values]).alias("cell"))


_CANDIDATES = "array<struct<kind:int,start:int,end:int,ok:boolean,base:boolean,cell:string>>"


def candidates(text: Column) -> Column:
    """All proposed spans of a text, those of the base generators first."""
    none = F.array().cast(_CANDIDATES)

    def of(kind: str, pattern: str, base: bool, t: Column, parts: Column) -> Column:
        each = F.transform(matches(t, pattern), lambda at: _candidate(kind, parts, at, base))
        return F.when(t.rlike(_NEEDS[kind]), each).otherwise(none).cast(_CANDIDATES)

    def proposed(bound: Column) -> Column:
        t, parts = bound["t"], bound["parts"]
        return F.concat(*[of(k, BASE[k], True, t, parts) for k in KINDS], *[of(k, p, False, t, parts) for k, p in MORE])

    every = let(F.struct(text.alias("t"), blocks(text).alias("parts")), proposed)
    return F.when(text.rlike(r"[0-9@]|(?i)[\[({]at[\])}]"), every).otherwise(none)


def accepted_cells(found: DataFrame, column: str = "found", rounds: int = 12, depth: int = 3, precision: float = 0.9) -> list[str]:
    """Cells whose score reaches the threshold of their kind: the lowest score from which on the labelled candidates
    reach ``precision``. Only sums by cell are gathered, at most as many as there are combinations of feature values."""
    each = found.select(F.explode(column).alias("c")).select("c.*")
    sums = materialise(each.groupBy("cell").agg(
        F.count_if(F.col("base") & F.col("ok")).alias("held"), F.count_if(F.col("base") & ~F.col("ok")).alias("failed")), "pii_cells")
    cells = sums.select("*", *[F.split("cell", ",")[i].cast("double").alias(f) for i, f in enumerate(FEATURES)])
    cells = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(cells)
    rows = cells.select("features", F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), F.col("held").cast("double").alias("weight")),
        F.struct(F.lit(0.0).alias("label"), F.col("failed").cast("double").alias("weight")))).alias("r")).select("features", "r.*").where("weight > 0")
    if rows.select("label").distinct().count() < 2:
        return []
    trees = GBTClassifier(maxIter=rounds, maxDepth=depth, weightCol="weight", seed=1, stepSize=0.3).fit(rows.coalesce(1))
    scored = trees.transform(cells).select("cell", "kind", "held", "failed", vector_to_array("probability")[1].alias("score"))
    accepted: list[str] = []
    table = sorted(scored.collect(), key=lambda r: -r["score"])
    for kind in range(len(KINDS)):
        own = [r for r in table if r["kind"] == kind]
        held = total = 0
        threshold = None
        for r in own:
            held, total = held + r["held"], total + r["held"] + r["failed"]
            if total and held >= precision * total:
                threshold = r["score"]
        if threshold is not None:
            accepted += [r["cell"] for r in own if r["score"] >= threshold]
    return accepted


def select_spans(found: Column, accepted: list[str]) -> Column:
    """Selected spans as array<struct<kind, start, end, base>>, by kind, then start."""
    plain = lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["base"].alias("base"))
    key = lambda c: c["start"].cast("bigint") * len(KINDS) + c["kind"]
    base = lambda all_: F.filter(all_, lambda c: c["base"] & c["ok"])
    cells = F.array(*[F.lit(c) for c in accepted]).cast("array<string>")

    def joined(all_: Column) -> Column:
        def with_more(kept: Column) -> Column:
            more = F.filter(all_, lambda c: ~c["base"] & c["ok"] & F.array_contains(cells, c["cell"]))

            def apart(rest: Column) -> Column:
                fresh = F.array_except(F.transform(rest, key), F.transform(kept, key))
                return F.filter(rest, lambda c: F.array_contains(fresh, key(c)) & ~F.exists(
                    kept, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))

            fresh = let(let(more, apart), lambda new: F.filter(new, lambda c, i: ~F.exists(
                F.slice(new, F.lit(1), i), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))))
            return F.array_sort(F.transform(F.concat(kept, fresh), plain))

        return let(base(all_), with_more)

    return let(found, joined)


def spans_string(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """Replace each run of overlapping spans by the name of its first one's kind in square brackets."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    runs_type = "array<struct<start:int,end:int,kind:int>>"

    def grown(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] > s["start"]),
                      F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(wider))).otherwise(F.concat(acc, F.array(s))).cast(runs_type)

    def rebuilt(bound: Column) -> Column:
        parts, runs = bound["parts"], bound["runs"]
        ends = lambda i: F.when(i > 0, F.element_at(runs, F.greatest(i, F.lit(1)))["end"]).otherwise(0)
        pieces = F.transform(runs, lambda r, i: F.concat(cut(parts, ends(i), r["start"]), F.element_at(names, r["kind"] + 1)))
        return F.concat(F.array_join(pieces, ""), cut(parts, F.element_at(runs, -1)["end"], F.size(parts) * BLOCK))

    runs = F.aggregate(by_start, F.array().cast(runs_type), grown)
    return F.when(F.size(spans) == 0, text).otherwise(let(F.struct(blocks(text).alias("parts"), runs.alias("runs")), rebuilt))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", null_to_empty().alias("text"))
    found = materialise(docs.select("doc_id", candidates(F.col("text")).alias("found")), "pii_candidates")
    chosen = found.select("doc_id", select_spans(F.col("found"), accepted_cells(found)).alias("spans"))
    base = F.filter("spans", lambda s: s["base"])


    def count(kind: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    return chosen.select("doc_id", *map(count, range(len(KINDS))), F.sha2(spans_string(base), 256).alias("base_sha256"), spans_string(F.col("spans")).alias("spans"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their personal data replaced; n_chars follows the text. A text without any stays as it is."""
    accepted = accepted_cells(docs.select(candidates(null_to_empty()).alias("found")))
    spans = select_spans(candidates(null_to_empty()), accepted)
    clean = docs.withColumn("text", let(spans, lambda s: redact(null_to_empty(), s)))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)
