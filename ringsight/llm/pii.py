"""Personal data: fixed patterns as seeds, and context patterns bootstrapped from them. DataFrame functions only.

Base spans come from one pattern per kind, leftmost and not overlapping; a match that fails its check (parts of an address,
digits and check sum of a card, digits of a phone number) is dropped. A text is split at the matches, and the lengths of pieces
and matches give the places, in code points. Patterns of long runs use possessive repeats and look-behinds, which find the same
matches in linear time.

The method then finds identifiers that the fixed patterns miss:
- Instances: base spans, and runs of words that hold a digit or an @, or spell one out ("jane at mail dot org"). Words one space
  apart are one run, unless a mark ends the first or one of them belongs to a base span.
- An instance has contexts (the two words before it, of which the first may be the start of the text; the words on both sides) and
  a shape (letters as a, digits as 9, with the number of digits). Contexts and shapes are the two sides of a graph around the identifiers.
- Seeds: the identifiers of base spans. A context is strong for a kind if, of the different identifiers it is seen with, at least
  `SUPPORT` are believed to be of the kind, and they are a share of at least `CONFIDENCE` (`believed / (all + PRIOR)`).
- An instance in a strong context is reached if it holds what every form of the kind holds (`holds`). It is kept if its shape
  belongs to the kind: at least `SHAPE` of the different identifiers of that shape are reached or seeds. So a strong context
  admits a shape that no seed has, and a shape that is common elsewhere (years, prices) stays out.
- Identifiers kept are believed from the next round on and may make further contexts strong, until a round finds none. Each
  round is written to the shared folder. Instances kept are added as spans of the kind, each by a context of its own.

Null texts count as empty; null or repeated ids are fine (each row is numbered). Base spans are always kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringsight.session import materialize

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "[A-Za-z0-9._%+-]"
#: A match starts where the last one ended, or where the run starts.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9]){12,}+",  # shorter runs of digits never pass
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold to have a match at all.
_NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
PRIOR, CONFIDENCE, SUPPORT, SHAPE = 2.0, 0.8, 5, 0.5
_DOT = r"\s++(?:dot|[\[(]dot[\])])\s++\S++"
_SPELLED = rf"\S++\s++(?:[\[(]at[\])]\s++\S++(?:{_DOT})*+|at\s++\S++(?:{_DOT})++)"
_MARKED = r"\S*?(?:[0-9@]|[\[(]at[\])])\S*+"
#: A word that holds a digit, an @ or a bracketed at, or an address spelled out.
ITEM = rf"(?i)(?<!\S)(?:{_SPELLED}|{_MARKED})"
#: What a text must hold to have an item at all.
_SOME = r"(?i)[0-9@]|[\[(]at[\])]|\sat\s"


def _passes(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    if kind == "ip":
        def small(part):
            value = F.regexp_replace(part, "^0+", "")
            return F.when(F.length(value) <= 3, F.coalesce(value.try_cast("int"), F.lit(0)) <= 255).otherwise(False)

        return F.forall(F.split(match, r"\."), small)
    if kind == "card":
        places = F.sequence(F.lit(1), n)

        def luhn(total, i):
            digit = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
            double = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
            return total + F.when(i % 2 == 0, double).otherwise(digit)

        return F.when(n.between(13, 19), F.aggregate(places, F.lit(0), luhn) % 10 == 0).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, match) in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.char_length(g))
    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("match"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,match:string>>").alias("spans"))

    def step(state, pair):
        start = state["at"] + pair["gap"]
        end = start + F.char_length(pair["match"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["match"].alias("match"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    return F.aggregate(pairs, zero, step)["spans"]


_SPANS = "array<struct<start:int,end:int,match:string>>"


def base_spans(text: Column, kind: str) -> Column:
    """The kind's matches that pass; empty for texts that lack what every match holds."""
    found = F.filter(_matches(text, PATTERNS[kind]), lambda s: _passes(kind, s["match"]))
    none = F.array().cast(_SPANS)
    return F.when(F.contains(text, F.lit(_NEEDS[kind])) & text.rlike("@" if kind == "email" else "[0-9]"), found).otherwise(none)


def holds(kind: str, core: Column) -> Column:
    """Whether a run has what every form of the kind has, fixed pattern or not."""
    digits = F.length(F.regexp_replace(core, "[^0-9]", ""))
    if kind == "email":
        return core.rlike(rf"(?i)^(?:[^\s@]+@[^\s@]+|\S+?[\[(]at[\])]\S+|{_SPELLED})$")
    if kind == "ip":
        groups = r"^(?=.*[0-9A-Fa-f])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=.*::)[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7})$"
        return core.rlike(r"^[0-9]+(?:\.[0-9]+){3}$") | core.rlike(groups)
    if kind == "card":
        return core.rlike(r"^[0-9](?:[^\p{L}\p{N}@]?[0-9]){12,18}$") & _passes(kind, core)
    return core.rlike(r"^[+(]?[0-9][0-9() ./-]*$") & digits.between(7, 15)


def _shape(core: Column) -> Column:
    """Letters as a, digits as 9; the number of digits where there are no letters; spelled words between stay."""
    spelled = F.regexp_replace(F.lower(core), r"(?<=\s)(at|dot)(?=\s)", "\u0001$1\u0001")
    letters = F.regexp_replace(spelled, r"(?<!\u0001)(?<![\p{L}])[\p{L}]+(?!\u0001)", "a")
    short = F.regexp_replace(F.regexp_replace(letters, "[0-9]+", "9"), "\u0001", "")
    digits = F.length(F.regexp_replace(core, "[^0-9]", "")).cast("string")
    return F.when(core.rlike(r"[\p{L}@]"), F.regexp_replace(short, "[a9]*a[a9]*", "a")).otherwise(F.concat_ws("/", short, digits))


def _plain(word: Column) -> Column:
    """A context word: lower case, no marks unless it is all marks, digits as 9."""
    low = F.lower(word)
    bare = F.regexp_replace(low, r"[^\p{L}\p{N}]+", "")
    return F.regexp_replace(F.when(bare == "", low).otherwise(bare), "[0-9]+", "9")


def _listed_items() -> Column:
    """The items of a text, from the columns found (matches) and gaps (text between them)."""
    n = F.size("found")
    parts = F.arrays_zip(F.slice("gaps", 1, n).alias("gap"), F.col("found").alias("word"), F.slice("gaps", 2, n).alias("next"))

    def last_words(gap: Column) -> Column:
        tail = F.substring_index(F.regexp_replace(gap, r"(?<!\s)\s++$", ""), " ", -2)
        return F.slice(F.reverse(F.filter(F.split(tail, r"\s+"), lambda w: w != "")), 1, 2)

    return F.transform(
        parts,
        lambda p: F.struct(
            F.char_length(p["gap"]).alias("gap"),
            (p["gap"] == " ").alias("joins"),
            last_words(p["gap"]).alias("before"),
            p["word"].alias("word"),
            F.regexp_extract(p["next"], r"^\s*+(\S+)", 1).alias("after"),
        ),
    )


def _placed(rows: DataFrame) -> DataFrame:
    """(row, i, start, end, word, joins, before, after) of the items; joins: one space parts it from the last one."""
    flat = rows.select("row", F.posexplode("items").alias("i", "w"))
    order = Window.partitionBy("row").orderBy("i")
    end = F.sum(F.col("w.gap") + F.char_length("w.word")).over(order)
    older = F.lag("w.word").over(order)
    # the nearest word first; an item in front counts as a word
    before = F.slice(F.concat("w.before", F.when(older.isNull(), F.array().cast("array<string>")).otherwise(F.array(older))), 1, 2)
    return flat.select(
        "row", "i", (end - F.char_length("w.word")).cast("int").alias("start"), end.cast("int").alias("end"),
        "w.word", "w.joins", before.alias("before"), "w.after",
    )


def instances(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """(row, start, end, seed, ident, shape, kinds, contexts). rows: (row, items); spans: (row, kind, start, end, match), base ones.

    seed: the kind of a base span, or null; kinds: those whose needs a run meets; contexts: the words around it, null if none.
    """
    items = _placed(rows)
    last = spans.select("row", F.col("start").alias("at"), F.lit(1).alias("turn"), F.struct("end", "start", "kind", "match").alias("span"))
    both = items.withColumns({"at": F.col("end"), "turn": F.lit(0)}).unionByName(last, allowMissingColumns=True)
    # the span of those that begin before an item's end which reaches farthest: if none overlaps by this one, none does
    so_far = Window.partitionBy("row").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, 0)
    cover = F.max("span").over(so_far)
    seen = both.withColumn("cover", cover).where("turn = 0").drop("at", "turn", "span")
    seen = seen.withColumn("cover", F.when(F.col("cover.end") > F.col("start"), F.col("cover")))
    order = Window.partitionBy("row").orderBy("i")
    held = F.col("cover").isNotNull()
    same = held & F.lag("cover").over(order).eqNullSafe(F.col("cover"))
    apart = ~F.col("joins") | held | F.lag("cover").over(order).isNotNull() | F.lag("word").over(order).rlike("[,;:!?.]$")
    opens = (~same & F.coalesce(apart, F.lit(True))) | F.lag("word").over(order).isNull()
    runs = seen.withColumn("opens", opens.cast("int")).withColumn("run", F.sum("opens").over(order))
    whole = runs.groupBy("row", "run").agg(
        F.min("start").alias("start"), F.min_by("before", "i").alias("before"), F.max_by("after", "i").alias("after"), F.max("cover").alias("span"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda w: w["word"]), " ").alias("text"),
    )
    # marks around a run do not belong to it; an opening bracket does if it is closed inside
    lead = F.when(F.col("text").rlike(r"^[^\p{L}\p{N}+]*\([^()]*[0-9]\)"), F.regexp_extract("text", r"^[^\p{L}\p{N}+(]*", 0)).otherwise(
        F.regexp_extract("text", r"^(?:[^\p{L}\p{N}+:]|:(?!:))*", 0)
    )
    inner = F.regexp_replace(F.substring("text", F.char_length(lead) + 1, F.char_length("text")), r"(?<=[\p{L}\p{N}])[^\p{L}\p{N}]++$", "")
    core = F.coalesce("span.match", inner)
    begin = F.coalesce("span.start", (F.col("start") + F.char_length(lead)).cast("int"))
    made = whole.select(
        "row", begin.alias("start"), core.alias("core"), F.col("span.kind").alias("seed"),
        F.transform("before", _plain).alias("before"), _plain(F.col("after")).alias("after"),
    ).where("core <> ''")
    one, two = F.get("before", F.lit(0)), F.coalesce(F.get("before", F.lit(1)), F.lit("^"))
    contexts = F.array_compact(
        F.array(
            F.when(one.isNotNull(), F.concat_ws(" ", F.lit("<<"), two, one)),
            F.when(one.isNotNull() & (F.col("after") != ""), F.concat_ws(" ", F.lit("<>"), one, "after")),
        )
    )
    digits = F.regexp_replace("core", "[^0-9]", "")
    kinds = F.array_compact(F.array(*[F.when(holds(k, F.col("core")), F.lit(k)) for k in KINDS]))
    return made.select(
        "row", "start", (F.col("start") + F.char_length("core")).cast("int").alias("end"), "seed",
        F.when(F.col("core").rlike(r"[\p{L}:]"), F.lower("core")).otherwise(digits).alias("ident"),
        _shape(F.col("core")).alias("shape"), kinds.alias("kinds"), contexts.alias("contexts"),
    )


def _better(kind: str = "kind", confidence: str = "confidence") -> Column:
    """The kind of the greatest confidence; of equal ones the first in alphabetical order."""
    return F.min_by(kind, F.struct(-F.col(confidence), F.col(kind)))


def bootstrap(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(strong contexts: context, kind, confidence, support; shapes: shape, kind), when no round finds more.

    Instances are summed to one row per context or shape and identifier first, so frequent ones cost no more than rare ones.
    """
    # ends: identifiers around every context that can have enough of them
    ends = found.select(F.explode("contexts").alias("context"), "ident").distinct()
    total = ends.groupBy("context").agg(F.count("*").alias("total")).where(F.col("total") >= SUPPORT)
    total = materialize(total, "pii-contexts")
    ends = materialize(ends.join(total, "context", "left_semi"), "pii-ends")
    shapes = materialize(found.select("shape", "ident").distinct().groupBy("shape").agg(F.count("*").alias("all")), "pii-shapes")
    seeds = materialize(found.where("seed is not null").groupBy("shape", "ident").agg(F.min("seed").alias("kind")), "pii-seeds")
    free = found.where(F.col("seed").isNull() & (F.size("kinds") > 0))
    free = free.select(F.explode("contexts").alias("context"), "ident", "shape", "kinds").distinct()
    free = materialize(free.join(total, "context", "left_semi"), "pii-open")
    belief = materialize(seeds.groupBy("ident").agg(F.min("kind").alias("kind")), "pii-belief")
    while True:
        believed = ends.join(belief, "ident").groupBy("context", "kind").agg(F.count("*").alias("support"))
        confidence = F.col("support") / (F.col("total") + PRIOR)
        scored = believed.where(F.col("support") >= SUPPORT).join(total, "context").withColumn("confidence", confidence)
        strong = materialize(scored.where(confidence >= CONFIDENCE).select("context", "kind", "confidence", "support"), "pii-strong")
        reached = (
            free.join(strong, "context").where(F.array_contains("kinds", F.col("kind")))
            .groupBy("shape", "ident").agg(_better().alias("kind"))
        )
        reached = materialize(reached, "pii-reached")
        inside = reached.unionByName(seeds).distinct().groupBy("shape", "kind").agg(F.count("*").alias("n"))
        fit = materialize(inside.join(shapes, "shape").where(F.col("n") >= SHAPE * F.col("all")).select("shape", "kind"), "pii-fit")
        new = reached.join(fit, ["shape", "kind"]).groupBy("ident").agg(F.min("kind").alias("kind")).join(belief, "ident", "left_anti")
        new = materialize(new, "pii-new")
        if new.isEmpty():
            return strong, fit
        belief = materialize(belief.unionByName(new), "pii-belief")


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_<kind>, base_sha256, spans, n_added) for every row."""
    rows = docs.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), F.coalesce(text, F.lit("")).alias("text"))
    places = [base_spans(F.col("text"), k).alias(k) for k in KINDS]
    scan = F.when(F.col("text").rlike(_SOME), F.col("text")).otherwise("")
    rows = rows.select("key", "row", *places, scan.alias("scan"))
    found = F.regexp_extract_all("scan", F.lit(ITEM), F.lit(0))
    rows = rows.select("key", "row", *KINDS, found.alias("found"), F.split("scan", ITEM, -1).alias("gaps"))
    # rows are numbered, and read, once
    spans = materialize(rows.select("key", "row", *KINDS, _listed_items().alias("items")), "pii-base")

    def named(kind: str) -> Column:
        return F.transform(F.col(kind), lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["match"].alias("match")))

    every = F.concat(*[named(k) for k in KINDS])
    known = spans.select("row", F.explode(every).alias("s")).select("row", "s.*")
    marked = materialize(instances(spans.where(F.size("items") > 0), known), "pii-marked")
    strong, fit = bootstrap(marked)
    added = (
        marked.where(F.col("seed").isNull() & (F.size("kinds") > 0))
        .select("row", "start", "end", "shape", "kinds", F.explode("contexts").alias("context"))
        .join(strong, "context").where(F.array_contains("kinds", F.col("kind")))
        .join(fit, ["shape", "kind"])
        .groupBy("row", "start", "end").agg(_better().alias("kind"))
        .groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("extra"))
    )

    def listed(kind: str) -> Column:
        return F.transform(F.col(kind), lambda s: F.struct(F.lit(KINDS.index(kind)).alias("k"), s["start"].alias("start"), s["end"].alias("end")))

    def joined_text(found: Column) -> Column:
        names = F.array(*[F.lit(k) for k in KINDS])
        ordered = F.array_sort(found)
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", names[s["k"]], s["start"], s["end"])), ",")

    base = F.concat(*[listed(k) for k in KINDS])
    extra = F.transform(
        F.coalesce("extra", F.array().cast("array<struct<kind:string,start:int,end:int>>")),
        lambda s: F.struct((F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"]) - 1).cast("int").alias("k"), s["start"].alias("start"), s["end"].alias("end")),
    )
    return spans.join(added, "row", "left").select(
        F.col("key").alias(key),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined_text(base), 256).alias("base_sha256"),
        joined_text(F.concat(base, extra)).alias("spans"),
        F.size(extra).cast("long").alias("n_added"),
    )
