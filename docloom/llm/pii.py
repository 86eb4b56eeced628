"""Personal data: base patterns, and a bootstrapped search for identifiers they miss.

Base matches (e-mail, address, card, phone) are leftmost and don't overlap within
their kind. Places are found without a row for each match: a text is split at the
matches, and lengths of gaps and matches are added up. Possessive loops and starts
at run borders keep every expression linear in the text and free of recursion.

Bootstrap: base matches are seed instances. The last word in front of an instance and
the last two, lower-cased with digits folded, are two lexical patterns; both are read
from the text in front, whatever matches lie in it. All other tokens with a digit,
with the patterns in front of them, are candidate instances. Patterns
and instances make a graph of distinct pairs. In each round, until nothing moves any more, a pattern
scores the mean of its instances' scores (seeds 1, others what they have so far), if
enough distinct instances support it; an instance scores the best of its patterns.
Patterns at ``CONFIDENT`` or more at the end give their identifier-like candidates as
spans of kind ``id``, unless they touch a base span.

Only built-in functions are used. Pairs combine before each shuffle; a pattern in
front of a third of all instances is one sum, and joins on it can be split by
adaptive execution. A text's matches stay in its row; running sums go block by
block (sqrt(n) of sqrt(n)), so a text with many matches isn't quadratic.

Edge cases: NULL and empty texts have no spans; repeated rows have the same spans
each; ties of start go by kind; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.text import compute_once
from docloom.session import materialize

KINDS = ("email", "ip", "card", "phone", "id")
LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: A token with a digit.
TOKEN = r"(?<!\S)[^\s0-9]*+[0-9]\S*+"
#: What a discovered identifier must look like: so many digits or more, so many characters or more.
LEAST_DIGITS, LEAST_CHARS = 5, 7
CONFIDENT, SUPPORT = 0.8, 5
#: Confidences that move by no more than this have settled.
SETTLED = 1e-6
#: Characters in front of an instance that its pattern is read from.
CONTEXT_CHARS = 64


# ------------------------------------------------------- running totals -----
def running(df: DataFrame, out: str, values: Column, start: Column, step: Callable[[Column, Column], Column]) -> DataFrame:
    """Add ``out``: for each entry of ``values`` the fold of all entries before it, and last that of all."""
    df = compute_once(df, __values=values)
    size = F.size("__values")
    width = F.greatest(F.ceil(F.sqrt(size)).cast("int"), F.lit(1))
    blocks = F.sequence(F.lit(0), F.floor(size / width).cast("int"))
    df = compute_once(df, __width=width, __blocks=F.transform(blocks, lambda b: F.slice("__values", b * width + 1, width)))
    df = compute_once(df, __sums=F.transform("__blocks", lambda x: F.aggregate(x, start, step)))
    df = compute_once(df, __base=F.transform(F.sequence(F.lit(1), F.size("__sums")), lambda k: F.aggregate(F.slice("__sums", F.lit(1), k - 1), start, step)))
    places = F.sequence(F.lit(0), F.size("__values"))
    block = lambda i: F.floor(i / F.col("__width")).cast("int")
    # a block is a short array of its own: a slice costs its length, not the whole array's
    within = lambda i: F.slice(F.get("__blocks", block(i)), F.lit(1), i - block(i) * F.col("__width"))
    df = compute_once(df, **{out: F.transform(places, lambda i: F.aggregate(within(i), F.get("__base", block(i)), step))})
    return df.drop("__values", "__width", "__blocks", "__sums", "__base")


# --------------------------------------------------------------- matches ----
def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the Luhn sum of up to 19 digits is a multiple of ten."""
    one = lambda d, k: F.when(k % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))
    places = F.sequence(F.lit(0), F.length(digits) - 1)
    total = F.aggregate(places, F.lit(0), lambda s, k: s + one(F.substr(F.reverse(digits), k + 1, F.lit(1)).cast("int"), k))
    return total % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(F.split(value, r"\."), lambda p: (F.length(part(p)) < 3) | ((F.length(part(p)) == 3) & (part(p) <= "255")))
    if kind == "card":
        digits = digits_of(value)
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits_of(value)).between(9, 15)
    return F.lit(True)


def _found(text: Column, pattern: str, hint: Column) -> Column:
    """Matches in order: the length of the gap in front, the gap's end, the match, its length."""
    gaps, values = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    found = F.zip_with(F.slice(gaps, 1, F.size(values)), values, lambda g, v: F.struct(F.length(g).alias("gap"), F.right(g, F.lit(CONTEXT_CHARS)).alias("before"), v.alias("value"), F.length(v).alias("size")))
    return F.when(hint, found).otherwise(F.array().cast("array<struct<gap:int,before:string,value:string,size:int>>"))


def places(df: DataFrame, out: str, kind_no: int, pattern: str, hint: Column, kept: Callable[[Column], Column]) -> DataFrame:
    """Add ``out``: valid matches (start, kind_no, end, before, value) of ``text`` in order."""
    df = compute_once(df, __found=_found(F.col("text"), pattern, hint))
    # the end of the text up to each match: gaps and matches before it, as far as a context reaches
    end = lambda a, b: F.substr(F.concat(a, b), F.lit(-CONTEXT_CHARS))
    df = running(df, "__tail", F.transform("__found", lambda m: end(m["before"], m["value"])), F.lit(""), end)
    df = running(df, "__at", F.transform("__found", lambda m: (m["gap"] + m["size"]).cast("long")), F.lit(0).cast("long"), lambda a, b: a + b)
    spans = F.transform("__found", lambda m, i: F.struct((F.get("__at", i) + m["gap"]).alias("start"), F.lit(kind_no).alias("kind_no"), (F.get("__at", i) + m["gap"] + m["size"]).alias("end"), end(F.get("__tail", i), m["before"]).alias("before"), m["value"].alias("value")))
    return compute_once(df, **{out: F.filter(spans, lambda s: kept(s["value"]))}).drop("__found", "__at", "__tail")


def base_spans(df: DataFrame) -> DataFrame:
    """Add ``base``: all base spans by start, then kind. Rows need ``text`` without NULLs."""
    digit = F.col("text").rlike("[0-9]")
    for no, (kind, pattern) in enumerate(PATTERNS.items()):
        hint = F.col("text").contains(HINTS[kind]) if HINTS[kind] else F.lit(True)
        df = places(df, f"__{kind}", no, pattern, hint & (digit if kind != "email" else F.lit(True)), lambda v, kind=kind: valid(kind, v))
    return compute_once(df, base=F.array_sort(F.concat(*(F.col(f"__{k}") for k in PATTERNS)))).drop(*(f"__{k}" for k in PATTERNS))


def apart(df: DataFrame, tokens: str, out: str) -> DataFrame:
    """Add ``out``: the tokens that touch no base span. Both lie in one order of starts: a token is apart if no span before it reaches into it and none after it starts in it."""
    far = F.lit(2**62)
    row = lambda s, is_token: F.struct(s["start"].alias("start"), F.lit(is_token).alias("is_token"), s["end"].alias("end"), s["kind_no"].alias("kind_no"), s["before"].alias("before"), s["value"].alias("value"))
    df = compute_once(df, __all=F.array_sort(F.concat(F.transform("base", lambda s: row(s, 0)), F.transform(tokens, lambda s: row(s, 1)))))
    df = running(df, "__reach", F.transform("__all", lambda e: F.when(e["is_token"] == 0, e["end"]).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, b: F.greatest(a, b))
    df = running(df, "__next", F.reverse(F.transform("__all", lambda e: F.when(e["is_token"] == 0, e["start"]).otherwise(far))), far, lambda a, b: F.least(a, b))
    last = F.size("__all") - 1
    marked = F.transform("__all", lambda e, i: F.struct(e.alias("e"), ((e["is_token"] == 1) & (F.get("__reach", i) <= e["start"]) & (F.get("__next", last - i) >= e["end"])).alias("apart")))
    return compute_once(df, **{out: F.transform(F.filter(marked, lambda m: m["apart"]), lambda m: m["e"])}).drop("__all", "__reach", "__next")


def context(before: Column) -> Column:
    """The last two words and what parts them from the instance, white space as one space, lower-cased, digits as 0; empty if there is none."""
    words = F.regexp_extract(F.lower(before), r"(\S+\s+)?\S+\s*$", 0)
    return F.regexp_replace(F.regexp_replace(words, r"\s+", " "), "[0-9]", "0")


def patterns_of(context: Column) -> Column:
    """Both words, and the last one alone if it has a letter: signs and numbers alone are no cue."""
    last = F.regexp_extract(context, r"\S*\p{L}\S* ?$", 0)
    return F.array_distinct(F.array(context, last))


# ------------------------------------------------------------- bootstrap ----
def confident_patterns(pairs: DataFrame, confident: float = CONFIDENT, support: int = SUPPORT) -> DataFrame:
    """Patterns (``pattern``, ``confidence``) that hold after scoring the graph; ``pairs``: distinct (pattern, instance, seed).

    Scores only rise, so rounds end: once every confident pattern was confident before, as sure as it is now.
    """
    scored, before = pairs.withColumn("score", F.col("seed").cast("double")), None
    while True:
        sure = F.when(F.col("score") >= confident, 1)
        patterns = scored.groupBy("pattern").agg(F.avg("score").alias("confidence"), F.count(sure).alias("n_sure"))
        patterns = materialize(patterns.where((F.col("n_sure") >= support) & (F.col("confidence") >= confident)).select("pattern", "confidence"), "pii-patterns")
        if before is not None:
            known = before.select("pattern", F.col("confidence").alias("known"))
            moved = patterns.join(known, "pattern", "left").where(F.col("known").isNull() | (F.col("confidence") - F.col("known") > SETTLED))
            if not moved.head(1):
                return patterns
        elif not patterns.head(1):
            return patterns
        # only patterns with support carry scores on, so what is joined shrinks to them
        reached = pairs.join(patterns, "pattern").groupBy("instance").agg(F.max("confidence").alias("reached"))
        scored = materialize(pairs.join(reached, "instance", "left").select("pattern", "instance", "seed", F.greatest(F.col("seed").cast("double"), F.coalesce("reached", F.lit(0.0))).alias("score")), "pii-graph")
        before = patterns


def find(docs: DataFrame, confident: float = CONFIDENT, support: int = SUPPORT) -> DataFrame:
    """Rows (doc_id, text_key, base, extra): spans (start, kind_no, end) of every text, base and discovered."""
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = base_spans(rows)
    rows = places(rows, "token", len(PATTERNS), TOKEN, F.col("text").rlike("[0-9]"), lambda v: F.lit(True))
    rows = apart(rows, "token", "apart")
    instance = lambda s: F.struct(context(s["before"]).alias("pattern"), F.xxhash64(F.lower(s["value"])).alias("instance"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"))
    plain = lambda s: F.struct(s["start"].alias("start"), s["kind_no"].alias("kind_no"), s["end"].alias("end"))
    likely = lambda s: (F.length(s["value"]) >= LEAST_CHARS) & (F.length(digits_of(s["value"])) >= LEAST_DIGITS)
    shaped = lambda t: F.struct(t["pattern"].alias("pattern"), t["instance"].alias("instance"), t["start"].alias("start"), t["end"].alias("end"), likely(t).alias("likely"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_key"), F.transform("base", plain).alias("base"), F.transform(F.transform("base", instance), shaped).alias("seeds"), F.transform(F.transform(F.col("apart"), instance), shaped).alias("tokens"))
    rows = materialize(rows, "pii-spans")
    seen = rows.select(F.explode("seeds").alias("s"), F.lit(1).alias("seed")).unionByName(rows.select(F.explode("tokens").alias("s"), F.lit(0).alias("seed")))
    pairs = seen.select(F.explode(patterns_of(F.col("s.pattern"))).alias("pattern"), "s.instance", "seed").where("pattern <> ''").groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))
    patterns = confident_patterns(materialize(pairs, "pii-pairs"), confident, support)
    tokens = rows.select("doc_id", "text_key", F.explode("tokens").alias("t")).where("t.likely").select("doc_id", "text_key", F.explode(patterns_of(F.col("t.pattern"))).alias("pattern"), "t.start", "t.end")
    extra = tokens.join(patterns.select("pattern"), "pattern").groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set(F.struct("start", F.lit(len(PATTERNS)).alias("kind_no"), "end"))).alias("extra"))
    extra = extra.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "extra")
    none = F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint>>")
    return rows.join(extra, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left").select("doc_id", "text_key", "base", F.coalesce("extra", none).alias("extra"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kind = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind_no"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


# ------------------------------------------------------------- redaction ----
def redact(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; overlapping spans by the first one's."""
    columns = docs.columns
    spans = F.array_sort(F.concat("base", "extra"))
    hit = found.where((F.size("base") > 0) | (F.size("extra") > 0)).select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__k"), spans.alias("__spans")).dropDuplicates(["__d", "__k"])
    df = docs.join(hit, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.xxhash64("text") == F.col("__k")), "left")
    df = compute_once(df.withColumn("__spans", F.coalesce("__spans", F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint>>"))), __n=F.size("__spans"))
    # where the text goes on after the spans before each one
    df = running(df, "__from", F.transform("__spans", lambda s: s["end"]), F.lit(0).cast("long"), lambda a, b: F.greatest(a, b))
    # the text in stretches of about sqrt(n) spans, so that no span's place is counted from the text's start
    width = F.greatest(F.ceil(F.sqrt("__n")).cast("int"), F.lit(1))
    df = compute_once(df, __width=width, __starts=F.transform(F.sequence(F.lit(0), F.floor(F.col("__n") / width).cast("int")), lambda b: F.get("__from", b * width)))
    cut = F.transform("__starts", lambda low, b: F.substr("text", (low + 1).cast("int"), (F.coalesce(F.get("__starts", b + 1), F.length("text").cast("long")) - low).cast("int")))
    df = compute_once(df, __cuts=cut)
    block = lambda i: F.floor(i / F.col("__width")).cast("int")
    piece = lambda i, low, high: F.substr(F.get("__cuts", block(i)), (low - F.get("__starts", block(i)) + 1).cast("int"), F.greatest(high - low, F.lit(0)).cast("int"))
    label = lambda s: F.concat(F.lit("["), F.upper(F.element_at(F.array(*map(F.lit, KINDS)), s["kind_no"] + 1)), F.lit("]"))
    kept = F.transform("__spans", lambda s, i: F.when(s["start"] >= F.get("__from", i), F.concat(piece(i, F.get("__from", i), s["start"]), label(s))).otherwise(F.lit("")))
    last = piece(F.col("__n"), F.get("__from", F.col("__n")), F.length("text").cast("long"))
    text = F.when(F.col("__n") > 0, F.concat(F.array_join(kept, ""), last)).otherwise(F.col("text"))
    return df.withColumn("text", text).select(*columns)
