"""Personal data: fixed patterns as seeds, contextual bootstrapping for the rest.

Four kinds are found by fixed patterns (the base).  Base spans are the seeds: the
words beside them are lexical patterns, and patterns and identifiers form a
graph.  Scores go to and fro over it: a pattern is worth the share of trusted
identifiers of one kind among those it stands beside whose kind is known; unseen
ones that may be of the kind and are not trusted yet count neither for nor against
it.  An unseen identifier is worth its best pattern; identifiers above the threshold
are trusted from the next round on, and rounds go on until none is added.  Trusted
unseen identifiers become further spans.

Everything is DataFrame expressions.  Positions come from splitting a text at a
mark put around each match, and count code points, as Spark's ``length`` does.
Only marks, matches and the words beside them leave a text; identifiers with
their patterns are distinct before they are grouped, so a common word or a
common copy is a count, not a group.

Inputs and results that need saying: a null or empty text has no spans; equal
texts have equal spans, each row its own; ties of two kinds over one unseen
identifier go to the kind listed first; an unseen identifier never overlaps a
base span; an empty table gives no rows; further columns are kept by ``redact``
and not looked at otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.binding import let
from marquee.session import materialise

KINDS = ("email", "ip", "card", "phone")
MIN_SEEDS = 5  # distinct trusted identifiers that a pattern needs before it counts
TRUST = 0.8  # score from which an unseen identifier is trusted

_MARK, _OTHER = "\ue000", "\ue001"  # a text's own marks become the other character: same length, no match
_SPAN = "array<struct<kind:int,start:int,end:int,value:string,beside:array<string>>>"

# Each fixed pattern as asked for, made safe for long texts: it can only begin
# where a run begins, and it gives nothing back.
_LOCAL = "[A-Za-z0-9._%+-]"
_PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_NEEDS = {"email": "[@]", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"[+][0-9]"}

# Identifiers that the fixed patterns do not know: digit groups, addresses
# without a domain ending, colon-separated hexadecimal groups.
_UNSEEN = (
    r"(?<![0-9A-Za-z+.])[0-9](?:[ ().-]{0,2}[0-9]){6,18}+(?![0-9A-Za-z])"
    r"|(?<![^\s<(\[\"'])[A-Za-z0-9._%+-]{1,64}+(?:@|\(at\)|\[at\])[A-Za-z0-9-]++"
    r"|(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{0,4}){3,7}+(?![0-9A-Za-z:])"
)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit of a digit string is right."""
    def worth(i):
        digit = digits.substr(-i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, digit).when(digit > 4, digit * 2 - 9).otherwise(digit * 2)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + worth(i))
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike("^0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))
    digits = _digits(value)
    if kind == "card":
        return F.length(digits).between(14, 19) & _luhn(digits)
    return F.length(digits).between(10, 15)


def _beside(before: Column, after: Column) -> Column:
    """Lexical patterns of a span: the word before, the two words before, the word after."""
    left = F.lower(F.right(before, F.lit(48)))
    one = F.regexp_extract(left, r"(\S+)\s*$", 1)
    two = F.regexp_extract(left, r"(\S+\s+\S+)\s*$", 1)
    right = F.regexp_extract(F.lower(F.left(after, F.lit(24))), r"^\s*(\S+)", 1)
    named = F.array(F.concat(F.lit("<"), one), F.concat(F.lit("<<"), two), F.concat(F.lit(">"), right))
    return F.filter(named, lambda p: F.length(F.regexp_replace(p, "^[<>]+", "")) > 0)


def _matches(text: Column, pattern: str, needs: str, kind: int) -> Column:
    """Spans of all leftmost, non-overlapping matches of a pattern."""

    def spans(parts, sizes):
        def span(i):
            start = F.aggregate(F.slice(sizes, 1, i), F.lit(0), lambda a, n: a + n)
            value = F.element_at(parts, i + 1)
            return F.struct(
                F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(value)).alias("end"),
                value.alias("value"), _beside(F.element_at(parts, i), F.element_at(parts, i + 2)).alias("beside"),
            )

        found = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 2, F.lit(1)), F.lit(2)), span)
        return F.when(F.size(parts) > 2, found)

    parts = F.split(F.regexp_replace(text, pattern, f"{_MARK}$0{_MARK}"), _MARK)
    found = let(parts, lambda p: let(F.transform(p, F.length), lambda n: spans(p, n)))
    return F.coalesce(F.when(text.rlike(needs), found), F.array().cast(_SPAN))


def base_spans(text: Column) -> Column:
    """All valid spans of the fixed patterns."""

    def valid(kind):
        return lambda s: _valid(kind, s["value"])

    return F.concat(*[F.filter(_matches(text, _PATTERNS[kind], _NEEDS[kind], i), valid(kind)) for i, kind in enumerate(KINDS)])


def _shapes(value: Column) -> Column:
    """The kinds that an unseen identifier may be of."""
    n = F.length(_digits(value))
    digits_only = ~value.rlike("[A-Za-z:@]")
    may = [
        value.rlike(r"@|\(at\)|\[at\]"),
        value.rlike("^[0-9A-Fa-f:]+$") & value.rlike(":"),
        digits_only & n.between(12, 19),
        digits_only & n.between(7, 15),
    ]
    return F.filter(F.array(*[F.when(m, F.lit(i)) for i, m in enumerate(may)]), lambda k: k.isNotNull())


def _annotated(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with columns _text_id, _base and _unseen."""
    raw = F.coalesce(F.col(text), F.lit(""))
    clean = F.when(raw.contains(_MARK), F.translate(raw, _MARK, _OTHER)).otherwise(raw)

    def free(base, unseen):
        return F.filter(unseen, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))

    def both(t):
        unseen = _matches(t, _UNSEEN, r"[0-9@]|\(at\)|\[at\]", -1)
        return let(base_spans(t), lambda base: F.struct(base.alias("base"), let(unseen, lambda u: free(base, u)).alias("unseen")))

    found = docs.withColumn("_text_id", F.md5(raw)).withColumn("_found", let(clean, both))
    return found.withColumn("_base", F.col("_found.base")).withColumn("_unseen", F.col("_found.unseen")).drop("_found")


def bootstrap(annotated: DataFrame, min_seeds: int = MIN_SEEDS, trust: float = TRUST) -> DataFrame:
    """(value, kind) of the unseen identifiers that the pattern-instance graph trusts."""
    seeds = annotated.select(F.explode("_base").alias("s")).select("s.kind", "s.value", F.explode("s.beside").alias("pattern"))
    others = annotated.select(F.explode("_unseen").alias("s")).select("s.value", "s.beside")
    others = others.select(F.explode(_shapes(F.col("value"))).alias("kind"), "value", "beside")
    others = others.select("kind", "value", F.explode("beside").alias("pattern"))
    edges = seeds.withColumn("seed", F.lit(1)).unionByName(others.withColumn("seed", F.lit(0)))
    edges = edges.groupBy("pattern", "kind", "value").agg(F.max("seed").alias("seed"))
    edges = materialise(edges, "pii-edges")
    # an identifier that may be of two kinds is one identifier of its pattern
    sizes = edges.select("pattern", "value").distinct().groupBy("pattern").agg(F.count("*").alias("all"))
    sizes = materialise(sizes, "pii-patterns")
    unseen = edges.where("seed = 0")
    trusted = unseen.select("value", "kind").limit(0)
    while True:
        now = edges.join(trusted.withColumnRenamed("kind", "found"), "value", "left")
        good = (F.col("seed") == 1) | F.coalesce(F.col("found") == F.col("kind"), F.lit(False))
        open_ = (F.col("seed") == 0) & F.col("found").isNull()
        by_kind = now.groupBy("pattern", "kind").agg(F.count_if(good).alias("good"), F.count_if(open_).alias("open"))
        patterns = by_kind.where(F.col("good") >= min_seeds).join(sizes, "pattern")
        patterns = patterns.select("pattern", "kind", (F.col("good") / (F.col("all") - F.col("open"))).alias("worth")).where(F.col("worth") >= trust)
        scored = unseen.join(patterns, ["pattern", "kind"]).groupBy("value", "kind").agg(F.max("worth").alias("score"))
        best = F.max_by("kind", F.struct("score", -F.col("kind")))
        added = scored.join(trusted, "value", "left_anti").groupBy("value").agg(best.alias("kind"))
        added = materialise(added, "pii-added")
        if added.isEmpty():
            return trusted
        trusted = materialise(trusted.unionByName(added), "pii-trusted")


def _extra(annotated: DataFrame, trusted: DataFrame) -> DataFrame:
    """(_text_id, _extra): spans of trusted identifiers by text."""
    mentions = annotated.where(F.size("_unseen") > 0).select("_text_id", "_unseen").dropDuplicates(["_text_id"])
    mentions = mentions.select("_text_id", F.explode("_unseen").alias("s")).select("_text_id", "s.start", "s.end", "s.value")
    hits = mentions.join(trusted, "value")
    return hits.groupBy("_text_id").agg(F.collect_list(F.struct("start", "kind", "end")).alias("_extra"))


def _ordered(spans: Column) -> Column:
    return F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def find_personal_data(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with arrays ``base`` and ``spans`` of (start, kind, end), both in order."""
    annotated = _annotated(docs.select(*dict.fromkeys([*keep, text])), text)
    annotated = materialise(annotated.select(*keep, "_text_id", "_base", "_unseen"), "pii-annotated")
    extra = _extra(annotated, bootstrap(annotated))
    both = F.concat(F.col("base"), F.coalesce(F.col("_extra"), F.array().cast("array<struct<start:int,kind:int,end:int>>")))
    return annotated.withColumn("base", _ordered(F.col("_base"))).join(extra, "_text_id", "left").select(
        *keep, "base", F.array_sort(both).alias("spans")
    )


def span_digest(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans): counts and digest of the base, all spans as text."""
    found = find_personal_data(docs, [key], text)

    def count(i):
        return F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")

    counts = [count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    return found.select(key, *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; overlapping spans become one, named by the first."""
    packed = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))  # no name of theirs meets one of ours
    annotated = materialise(_annotated(packed, "text"), "pii-annotated")
    extra = _extra(annotated, bootstrap(annotated))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    spans = F.array_sort(F.concat(_ordered(F.col("_base")), F.coalesce(F.col("_extra"), empty)))
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    source = F.col("text")

    def step(acc, s):
        gap = source.substr(acc["at"] + 1, s["start"] - acc["at"])
        fresh = s["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], gap, names[s["kind"]])).otherwise(acc["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("_spans", start, step, lambda acc: F.concat(acc["out"], source.substr(acc["at"] + 1, F.length(source))))
    joined = annotated.join(extra, "_text_id", "left").withColumn("_spans", spans)
    clean = F.when(F.size("_spans") > 0, clean).otherwise(source)
    return joined.select(*[clean.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])
