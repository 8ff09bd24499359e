"""Information-theoretic sanitisation with DataFrame functions only.

Personal data are found by patterns: emails, ip addresses, card and phone
numbers.  Each distinct value is a protected entity.  Words near its mentions
may give it away as well, so the corpus tells how strongly: for a term t that
stands within ``REACH`` words of entity c,

    PMI(t, c) = log(n(t, c) N / (df(t) df(c)))   IC(c) = log(N / df(c))

with the documents that have t near c, all documents, and those that hold t
and c anywhere.  PMI / IC is 1 if t never comes without c.  Terms from
``GENERALISE`` on are generalised and from ``REMOVE`` on removed, wherever they
stand, also in documents without the entity.  Only terms seen near the entity
in ``SUPPORT`` different contexts (the nearest words on each side) count, so that
copies of one passage are no evidence.

Positions come from the pieces between the matches, whose lengths are summed
up.  Patterns use possessive quantifiers, and look back where a run of
characters could otherwise be tried again at each of its characters, so that
long texts take time in proportion to their length and no deep stack.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import written

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold to be searched for a kind at all.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
REACH, SUPPORT = 10, 3
#: Words on each side that tell contexts apart: copies agree in them even if they were edited elsewhere.
NEAREST = 4
CONTEXT_CHARS = 240
GENERALISE, REMOVE = 0.7, 0.9
BLANKS = r"[\x20\x09-\x0D]+"
#: A term is a run of these, or runs joined by single hyphens, underscores or points.
TERM = r"\p{L}\p{M}\p{N}"
JOINED = rf"(?<![{TERM}])[{TERM}]++(?:[-_.][{TERM}]++)++"
#: A text is a row of matches of either: runs, or joined words as wholes, and what lies between.
RUNS = rf"[{TERM}]++|[^{TERM}]++"
WHOLES = rf"[{TERM}]++(?:[-_.][{TERM}]++)*+|[^{TERM}]++"
CHUNK = 256
#: A word is placed by those before it in its array, which its row carries until it is known to be a term or not.
PARTS = 32
#: Bits of the hash by which words that are no terms are told before they are moved.
HASH_BITS = 24

_SPANS = "array<struct<start:int,end:int,value:string>>"
_CUTS = "array<struct<at:int,parts:array<string>,whole:boolean>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _small_prefix(a: Column) -> Column:
    """0 and the running sums of a short array."""
    return F.aggregate(a, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))


def _prefix(a: Column) -> Column:
    """Sums of all earlier elements, for each; by chunks, so that long arrays stay linear."""
    last = F.greatest(F.floor((F.size(a) - 1) / CHUNK).cast("int"), F.lit(0))
    chunks = F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(a, c * CHUNK + 1, F.lit(CHUNK)))

    def shifted(chunks, ahead):
        return F.flatten(F.zip_with(chunks, F.slice(ahead, F.lit(1), F.size(chunks)), lambda c, before: F.transform(
            F.slice(_small_prefix(c), F.lit(1), F.size(c)), lambda x: x + before)))

    def sums(chunks):
        return _small_prefix(F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda t, x: t + x)))

    return _let(chunks, lambda c: _let(sums(c), lambda ahead: shifted(c, ahead)))


def spans(text: Column, pattern: Column) -> Column:
    """Start, end (in characters) and value of the leftmost non-overlapping matches."""
    def placed(values):
        gaps = F.slice(F.transform(F.split(text, pattern, -1), lambda p: F.length(p)), F.lit(1), F.size(values))
        return _let(gaps, lambda gap: _let(
            _prefix(F.zip_with(gap, values, lambda g, v: g + F.length(v))),
            lambda ahead: F.zip_with(F.zip_with(ahead, gap, lambda a, g: a + g), values, lambda start, v: F.struct(
                start.alias("start"), (start + F.length(v)).alias("end"), v.alias("value")))))

    none = F.array().cast(_SPANS)
    return _let(F.regexp_extract_all(text, pattern, F.lit(0)),
                lambda values: F.when(F.size(values) > 0, placed(values)).otherwise(none))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, nine less if over nine; the sum ends in 0."""
    back = F.reverse(digits)
    each = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: (
        F.get(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), F.substr(back, i, F.lit(1)).cast("int"))
        * F.when(i % 2 == 0, 1).otherwise(0)
        + F.substr(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 1).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda s, d: s + d) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike(
            r"^([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def base_spans(kind: str) -> Column:
    """The valid spans of a kind in the column ``text``."""
    found = F.filter(spans(F.col("text"), F.lit(PATTERNS[kind])), lambda s: _valid(kind, s["value"]))
    hint = F.contains("text", F.lit(HINTS[kind])) if HINTS[kind] else F.lit(True)
    if kind != "email":
        hint = hint & F.col("text").rlike("[0-9]")
    return F.when(hint, found).otherwise(F.array().cast(_SPANS))


def _words(piece: Column) -> Column:
    """Lower-case runs of letters and digits of any length, and joined ones ("ab-7731") as wholes too."""
    runs = F.filter(F.split(F.lower(piece), rf"[^{TERM}]+"), lambda w: w != "")
    return F.concat(runs, F.regexp_extract_all(F.lower(piece), F.lit(JOINED), F.lit(0)))


def _masked() -> Column:
    """``text`` with an @ for each character of a base span that is no blank."""
    def built(marks):
        ends = F.aggregate(marks, F.array(F.lit(0)), lambda acc, m: F.concat(
            acc, F.array(F.greatest(F.element_at(acc, -1), m["end"]))))
        return _let(ends, lambda at: F.concat(F.array_join(F.zip_with(
            marks, F.slice(at, F.lit(1), F.size(marks)), lambda m, a: F.concat(
                F.substr(F.col("text"), a + 1, F.greatest(m["start"] - a, F.lit(0))),
                F.regexp_replace(F.substr(m["value"], F.greatest(a - m["start"], F.lit(0)) + 1), r"[^\x20\x09-\x0D]", "@"))), ""),
            F.substr(F.col("text"), F.element_at(at, -1) + 1)))

    return _let(F.sort_array(F.concat(*KINDS)),
                lambda marks: F.when(F.size(marks) > 0, built(marks)).otherwise(F.col("text")))


def _mention(text: Column, kind: str, s: Column) -> Column:
    """Entity, its context's hash and the terms within REACH words."""
    def around(text):
        left = F.substr(text, F.greatest(s["start"] - CONTEXT_CHARS + 1, F.lit(1)),
                        F.least(s["start"], F.lit(CONTEXT_CHARS)))
        right = F.substr(text, s["end"] + 1, F.lit(CONTEXT_CHARS))
        before = F.split(F.rtrim(left), BLANKS)
        before = F.slice(before, F.greatest(F.size(before) - REACH + 1, F.lit(1)), F.lit(REACH))
        return before, F.slice(F.split(F.ltrim(right), BLANKS), F.lit(1), F.lit(REACH))

    before, after = around(text)
    # what lies in a base span is no term
    near = F.concat_ws(" ", *around(F.col("masked")))
    nearest = F.concat_ws(" ", F.slice(before, F.greatest(F.size(before) - NEAREST + 1, F.lit(1)), F.lit(NEAREST)),
                          F.slice(after, F.lit(1), F.lit(NEAREST)))
    return F.struct(F.concat(F.lit(kind + ":"), F.lower(s["value"])).alias("entity"),
                    F.xxhash64(nearest).alias("context"), F.array_distinct(_words(near)).alias("terms"))


def _mentions(kind: str) -> Column:
    return F.transform(kind, lambda s: _mention(F.col("text"), kind, s))


def _base(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({k: base_spans(k) for k in KINDS})
    rows = rows.withColumn("masked", _masked())
    mentions = F.concat(*map(_mentions, KINDS))
    return rows.select("doc_id", F.md5("text").alias("key"), *KINDS, mentions.alias("mentions"))


def revealing_terms(docs: DataFrame, base: DataFrame) -> DataFrame | None:
    """``term, share``: the largest PMI / IC of each term from GENERALISE on; None without candidates."""
    seen = base.select("doc_id", "key", F.explode("mentions").alias("m")).select(
        F.coalesce(F.col("doc_id").cast("string"), F.col("key")).alias("doc"), "m.*")
    entities = seen.groupBy("entity").agg(F.countDistinct("context").alias("contexts"), F.countDistinct("doc").alias("dc"))
    entities = written(entities.where(F.col("contexts") >= SUPPORT).select(F.col("entity").alias("e"), "dc"), "entities")
    if entities.isEmpty():
        return None
    near = seen.join(entities, F.col("entity") == F.col("e")).select("entity", "dc", "context", "doc", F.explode("terms").alias("term"))
    pairs = near.groupBy("entity", "term").agg(
        F.max("dc").alias("dc"), F.countDistinct("context").alias("contexts"), F.countDistinct("doc").alias("n"))
    pairs = written(pairs.where(F.col("contexts") >= SUPPORT).drop("contexts"), "pairs")
    wanted = written(pairs.select("term").distinct(), "wanted")
    if wanted.isEmpty():
        return None
    words = docs.select(F.explode(F.array_distinct(_words(F.col("text")))).alias("term"))
    # counted before the join, which then meets one row per term, however often it occurs
    counts = _maybe(words, _marks(wanted)).groupBy("term").agg(F.count("*").alias("dt")).join(wanted, "term", "left_semi")
    whole = docs.agg(F.count("*").cast("double").alias("total"))  # one row
    share = F.log(F.col("n") * F.col("total") / (F.col("dt") * F.col("dc"))) / F.log(F.col("total") / F.col("dc"))
    scored = pairs.join(counts, "term").crossJoin(F.broadcast(whole)).where("dc < total")
    scored = scored.groupBy("term").agg(F.max(share).alias("share"))
    return written(scored.where(F.col("share") >= GENERALISE), "terms")


def _marks(terms: DataFrame) -> DataFrame:
    """One row, ``bits``: a bit for each hash value that some term has, as longs; 2 MB at any number of terms."""
    longs = 1 << (HASH_BITS - 6)
    slot = _slot(F.col("term"))
    some = terms.select(F.shiftright(slot, 6).alias("i"), F.expr("1L").alias("one"), slot.bitwiseAND(63).cast("int").alias("at"))
    some = some.groupBy("i").agg(F.bit_or(F.expr("shiftleft(one, at)")).alias("b"))
    whole = terms.sparkSession.range(longs).withColumnRenamed("id", "i").join(some, "i", "left")
    return whole.agg(F.sort_array(F.collect_list(F.struct("i", F.coalesce("b", F.lit(0)).alias("b")))).alias("m")).select(
        F.col("m.b").alias("bits"))


def _slot(term: Column) -> Column:
    return F.xxhash64(term).bitwiseAND((1 << HASH_BITS) - 1)


def _maybe(words: DataFrame, marks: DataFrame) -> DataFrame:
    """``words`` whose ``term`` may be one of the marked: few others pass, so that joins move few rows."""
    slot = _slot(F.col("term"))
    bit = F.get("bits", F.shiftright(slot, 6).cast("int"))
    hit = F.expr("shiftright(b, at)").bitwiseAND(1) == 1
    rows = words.crossJoin(F.broadcast(marks))  # one row of fixed size
    return rows.withColumns({"b": bit, "at": slot.bitwiseAND(63).cast("int")}).where(hit).select(*words.columns)


def _cut(text: Column, pattern: str, whole: bool) -> Column:
    """``at, parts, whole``: the matches of a pattern that covers the text, in arrays of PARTS, and where each begins."""
    def cut(parts):
        last = F.greatest(F.floor((F.size(parts) - 1) / PARTS).cast("int"), F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(parts, c * PARTS + 1, F.lit(PARTS)))

    def placed(chunks):
        ahead = _prefix(F.transform(chunks, lambda c: F.length(F.array_join(c, ""))))
        return F.zip_with(ahead, chunks, lambda a, c: F.struct(a.alias("at"), c.alias("parts"), F.lit(whole).alias("whole")))

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda parts: _let(cut(parts), placed))


def _term_spans(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``d, k, term``: spans of the terms in each document that holds some.

    Every word is placed where the text is read; the words that are terms
    travel, never a text.  A run within a joined word that is a term itself
    is part of that word's span.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("d"), F.coalesce("text", F.lit("")).alias("text"))
    joined = F.when(F.col("text").rlike(rf"[{TERM}][-_.][{TERM}]"), _cut(F.col("text"), WHOLES, True))
    cuts = F.concat(_cut(F.col("text"), RUNS, False), F.coalesce(joined, F.array().cast(_CUTS)))
    words = rows.select("d", F.md5("text").alias("k"), F.explode(cuts).alias("cut")).select(
        "d", "k", "cut", F.posexplode("cut.parts").alias("i", "word"))
    words = words.where(~F.col("cut.whole") | F.col("word").rlike("[-_.]")).withColumn("term", F.lower("word"))
    words = _maybe(words, _marks(terms))
    start = F.col("cut.at") + F.length(F.array_join(F.slice("cut.parts", F.lit(1), F.col("i")), ""))
    words = words.select("d", "k", "term", "cut.whole", start.alias("start"), (start + F.length("word")).alias("end"))
    placed = words.join(terms, "term").select("d", "k", "whole", F.struct(
        "start", "end", (F.col("share") >= REMOVE).alias("removed")).alias("s"))
    placed = placed.groupBy("d", "k").agg(
        F.collect_set(F.when(~F.col("whole"), F.col("s"))).alias("runs"),
        F.collect_set(F.when(F.col("whole"), F.col("s"))).alias("wholes"))
    alone = F.filter("runs", lambda r: ~F.exists(
        "wholes", lambda w: (w["start"] <= r["start"]) & (r["end"] <= w["end"])))
    return written(placed.select("d", "k", F.sort_array(F.concat("wholes", alone)).alias("term")), "spans")


_TERM = "array<struct<start:int,end:int,removed:boolean>>"


def found(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, key`` (md5 of the text) and arrays of spans ``email, ip, card, phone, term``."""
    base = written(_base(docs), "base")
    terms = revealing_terms(docs, base)
    none = F.array().cast(_TERM)
    if terms is None or terms.isEmpty():
        return base.drop("mentions").withColumn("term", none)
    more = _term_spans(docs, terms)
    rows = base.drop("mentions").join(more, base["doc_id"].eqNullSafe(more["d"]) & (base["key"] == more["k"]), "left")
    return rows.select("doc_id", "key", *KINDS, F.coalesce("term", none).alias("term"))


def _listed(kind: str) -> Column:
    return F.transform(kind, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def report(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``.

    Spans are ``kind:start:end`` by kind, then start, joined by commas, ends
    exclusive, in code points; the digest is over the base kinds only.  A null
    text is empty; rows without id and repeated rows are reported like others;
    other columns are left aside.
    """
    rows = found(docs)
    base = F.array_join(F.concat(*map(_listed, KINDS)), ",")
    return rows.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.concat(*map(_listed, (*KINDS, "term"))), ",").alias("spans"))


def _labelled(kind: str) -> Column:
    return F.transform(kind, lambda s: F.struct(s["start"], s["end"], F.lit(f"[{kind.upper()}]").alias("by")))


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` cleaned: base spans by ``[KIND]``, terms generalised to ``[TERM]`` or removed.

    Of overlapping spans the first counts.  A null text stays null.
    """
    places = found(docs).dropDuplicates(["doc_id", "key"])
    marks = F.concat(
        *map(_labelled, KINDS),
        F.transform("term", lambda s: F.struct(s["start"], s["end"], F.when(s["removed"], "").otherwise("[TERM]").alias("by"))))
    places = places.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), F.sort_array(marks).alias("_m"))
    # the table's columns stay within one, so that none clashes with those beside it
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    key = F.md5(F.coalesce("row.text", F.lit("")))
    rows = rows.join(places, F.col("row.doc_id").cast("long").eqNullSafe(F.col("_d")) & (key == F.col("_k")))
    # where the text goes on after each mark, whatever came before
    ends = F.aggregate("_m", F.array(F.lit(0)), lambda acc, m: F.concat(
        acc, F.array(F.greatest(F.element_at(acc, -1), m["end"]))))
    text = _let(ends, lambda at: F.concat(
        F.array_join(F.zip_with("_m", F.slice(at, F.lit(1), F.size("_m")), lambda m, a: F.when(
            m["start"] >= a, F.concat(F.substr(F.col("row.text"), a + 1, m["start"] - a), m["by"])).otherwise("")), ""),
        F.substr(F.col("row.text"), F.element_at(at, -1) + 1, F.length("row.text"))))
    text = F.when(F.size("_m") == 0, F.col("row.text")).otherwise(text)
    return rows.select(*(text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns))
