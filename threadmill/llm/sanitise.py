"""Personal data: fixed kinds by pattern, and terms that reveal them by information theory.

Emails, ip addresses, card and phone numbers are protected entities. A word may give one away
after it is masked. How strongly is estimated from whole documents of the whole corpus: with n(k)
documents holding kind k, n(t) documents with word t outside all entities, n(t, k) with both, of N,

    disclosure(t, k) = PMI(t; k) / IC(k) = log2(n(t, k) N / (n(t) n(k))) / log2(N / n(k))

is the share of the entity's information that the word carries: 1 if it only occurs there, 0 or
less if it says nothing. Chance alone makes rare words look telling, so a word must also bring

    evidence(t, k) = n(t, k) log2(n(t, k) / (n(t) p)) + (n(t) - n(t, k)) log2((n(t) - n(t, k)) / (n(t) (1 - p)))

bits, p = n(k) / N, of at least log2 of the number of different words: then hardly one of them is
expected to get as far by chance. In documents that hold the kind, a word that
reaches GENERALISE is replaced by a general one wherever it stands, one that reaches REMOVE is
taken out.

Null text has no spans and stays null; an empty one likewise. Rows repeat as they are, null ids
are ids like any other, other columns pass through, an empty table gives an empty result.
Offsets are code points, ends exclusive. Only DataFrame expressions are used; work grows with a
text's length, whatever number of spans it holds, and lists of words with pieces of SEGMENT
characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import tokens_of
from threadmill.session import materialize

KINDS = ["email", "ip", "card", "phone"]
GENERALISE = 0.75
REMOVE = 0.9
TERM = "term"
#: Characters of a piece of text whose words are listed together; a word is never cut.
SEGMENT = 60_000
#: Matches or spans that one list expression goes through; longer lists are cut into such parts.
PART = 256
#: Terms, or rows with terms, that may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000

_SPAN = "array<struct<start:int,kind:int,end:int>>"

# A match can only begin at the end of the one before (\G) or where no longer one begins, so a
# long run of characters is tried once; after that the patterns find what the plain ones find.
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+",
    # Whole runs of digits with 14 to 19 of them: shorter and longer ones would be dropped anyway.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Cheap looks at a text that rule a kind out.
_HINTS = {
    "email": None,
    "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){13}",
    "phone": r"\+[0-9]",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"


_WORD = r"[\p{L}\p{N}]+"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _parts(items: Column) -> Column:
    """An array cut into arrays of PART items."""
    numbers = F.when(F.size(items) > 0, F.sequence(F.lit(0), F.floor((F.size(items) - 1) / PART).cast("int")))
    return F.transform(F.coalesce(numbers, F.array().cast("array<int>")), lambda i: F.slice(items, i * PART + 1, PART))


def _running(parts: Column, of) -> Column:
    """0, and after each part ``of(part, what it was before)``."""
    begin = F.array(F.lit(0))
    return F.aggregate(parts, begin, lambda out, p: F.concat(out, F.array(of(p, F.element_at(out, -1)).cast("int"))))


def _found(text: Column, pattern: str) -> Column:
    """(start, end, hit) of all matches: gaps and hits alternate, so their lengths add up to places."""
    whole = F.lit(rf"(?s)\G(.*?)({pattern})")
    pairs = F.arrays_zip(
        F.regexp_extract_all(text, whole, F.lit(1)).alias("gap"), F.regexp_extract_all(text, whole, F.lit(2)).alias("hit")
    )
    none = F.array().cast("array<struct<start:int,end:int,hit:string>>")

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.char_length(pair["gap"])
        end = start + F.char_length(pair["hit"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    def places(part: Column, at: Column) -> Column:
        return F.aggregate(part, F.struct(at.alias("at"), none.alias("out")), step, lambda s: s["out"])

    def length(part: Column, before: Column) -> Column:
        return F.aggregate(part, before, lambda n, x: n + F.char_length(x["gap"]) + F.char_length(x["hit"]))

    def long(parts: Column) -> Column:
        starts = F.slice(_running(parts, length), F.lit(1), F.size(parts))
        return F.flatten(F.zip_with(parts, starts, places))

    return _let(pairs, lambda p: F.when(F.size(p) <= PART, places(p, F.lit(0))).otherwise(_let(_parts(p), long)))


def _holds(kind: str, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "ip":
        return hit.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """All spans of the fixed kinds as (start, kind, end), by start, then kind."""
    def of(number: int, kind: str) -> Column:
        hint = F.contains(text, F.lit("@")) if _HINTS[kind] is None else text.rlike(_HINTS[kind])
        kept = F.filter(_found(text, _PATTERNS[kind]), lambda x: _holds(kind, x["hit"]))
        spans = F.transform(
            kept, lambda x: F.struct(x["start"].alias("start"), F.lit(number).alias("kind"), x["end"].alias("end"))
        )
        return F.when(hint, spans).otherwise(F.array().cast(_SPAN))

    return F.array_sort(F.concat(*[of(n, k) for n, k in enumerate(KINDS)]))


def _replaced(text: Column, spans: Column, label) -> Column:
    """The text with each span (by start; they may overlap) replaced by ``label(span, first place not yet passed)``."""

    def end(part: Column, before: Column) -> Column:
        return F.greatest(before, F.array_max(F.transform(part, lambda s: s["end"])))

    def put(part: Column, begin: Column) -> Column:
        # Only the piece of text that the part covers is cut again for each of its spans.
        def inner(piece: Column) -> Column:
            def step(state: Column, span: Column) -> Column:
                gap = F.substring(piece, state["at"] - begin + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
                out = F.concat(state["out"], F.array(gap, label(span, state["at"])))
                return F.struct(F.greatest(state["at"], span["end"]).alias("at"), out.alias("out"))

            start = F.struct(begin.alias("at"), F.array().cast("array<string>").alias("out"))
            return F.aggregate(part, start, step, lambda s: F.array_join(s["out"], ""))

        return _let(F.substring(text, begin + 1, end(part, begin) - begin), inner)

    def joined(parts: Column) -> Column:
        def over(ends: Column) -> Column:
            pieces = F.zip_with(parts, F.slice(ends, F.lit(1), F.size(parts)), put)
            return F.concat(F.array_join(pieces, ""), F.substring(text, F.element_at(ends, -1) + 1, F.char_length(text)))

        return _let(_running(parts, end), over)

    return F.when(F.size(spans) > 0, _let(_parts(spans), joined)).otherwise(text)


def _blanked(text: Column, base: Column) -> Column:
    """The text with blanks in place of all spans."""
    return _replaced(text, base, lambda s, at: F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(at, s["start"]), F.lit(0))))


def _segments(text: Column) -> Column:
    """(at, part): a text in pieces of about SEGMENT characters that cut no word."""
    cut = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{SEGMENT}}}+[\p{{L}}\p{{N}}]*+"), F.lit(0))

    def placed(parts: Column) -> Column:
        starts = _running(parts, lambda p, before: before + F.char_length(p))
        return F.zip_with(parts, F.slice(starts, F.lit(1), F.size(parts)), lambda p, at: F.struct(at.alias("at"), p.alias("part")))

    one = F.array(F.struct(F.lit(0).alias("at"), text.alias("part")))
    return F.when(F.char_length(text) <= SEGMENT, one).otherwise(_let(cut, placed))


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a table whose rows are counted and few; others are left to a shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _bit(kind: int) -> Column:
    return F.col("has").bitwiseAND(1 << kind) != 0


def disclosing_terms(found: DataFrame) -> DataFrame:
    """(term, kind, level) of the words that reveal a kind, from (row, has, blank): level 1 to generalise, 2 to remove."""
    kinds = range(len(KINDS))
    sizes = found.agg(F.count("*").alias("n"), *[F.count_if(_bit(k)).alias(f"n_{k}") for k in kinds]).first()
    n = float(sizes["n"])

    def words(part: str) -> Column:
        return F.explode(F.array_distinct(F.transform(F.regexp_extract_all(part, F.lit(_WORD), F.lit(0)), F.lower))).alias("term")

    short = F.char_length("blank") <= SEGMENT
    pieces = found.where(~short).select("row", "has", F.explode(_segments(F.col("blank"))).alias("s"))
    of_long = pieces.select("row", "has", words("s.part")).distinct().select("has", "term")
    each = found.where(short).select("has", words("blank")).unionByName(of_long)
    counted = each.groupBy("term").agg(F.count("*").alias("n_term"), *[F.count_if(_bit(k)).alias(f"n_{k}") for k in kinds])
    counted = materialize(counted, "counted")
    least = F.round(F.log2(F.lit(float(max(counted.count(), 1)))), 9)
    law = [
        F.struct(F.lit(k).alias("kind"), F.col(f"n_{k}").cast("double").alias("both"), F.lit(float(sizes[f"n_{k}"])).alias("held"))
        for k in kinds if 0 < sizes[f"n_{k}"] < n
    ]
    if not law:
        return counted.select("term", F.lit(0).alias("kind"), F.lit(0).alias("level")).limit(0)
    rows = counted.select("term", F.col("n_term").cast("double").alias("n_term"), F.explode(F.array(*law)).alias("k"))
    rows = rows.select("term", "n_term", "k.*").where("both > 0")
    lift = F.log2(F.col("both") * n / (F.col("n_term") * F.col("held")))
    apart = F.col("n_term") - F.col("both")
    # Where nothing stands apart its share is 0; the logarithm must still have an argument above 0.
    rest = apart * F.log2(F.greatest(apart, F.lit(1.0)) * n / (F.col("n_term") * (n - F.col("held"))))
    disclosure = F.round(lift / F.log2(n / F.col("held")), 9)
    enough = F.round(F.col("both") * lift + rest, 9) >= least
    told = rows.withColumn("disclosure", disclosure).where(enough & (F.col("disclosure") >= GENERALISE))
    return told.select("term", "kind", F.when(F.col("disclosure") >= REMOVE, 2).otherwise(1).alias("level"))


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows with ``base_spans`` and ``term_spans``; the latter have a level, 1 or 2.

    Columns of these names are replaced. Rows are stored once in the shared folder.
    """
    docs = docs.drop("base_spans", "term_spans")
    row = tokens_of("_row", docs.columns)
    based = F.coalesce(base_spans(F.col(text)), F.array().cast(_SPAN))
    found = materialize(docs.withColumn("base_spans", based).withColumn(row, F.monotonically_increasing_id()), "found")
    held = F.array_distinct(F.transform("base_spans", lambda b: b["kind"]))
    has = F.aggregate(held, F.lit(0), lambda n, k: n + F.pow(F.lit(2), k).cast("int"))  # a bit per kind
    blank = F.coalesce(_blanked(F.col(text), F.col("base_spans")), F.lit(""))
    plain = found.select(F.col(row).alias("row"), has.alias("has"), blank.alias("blank"))
    levels = materialize(disclosing_terms(plain), "terms")
    pieces = plain.where("has <> 0").select("row", "has", F.explode(_segments(F.col("blank"))).alias("s"))
    words = pieces.select("row", "has", F.col("s.at").alias("at"), F.explode(_found(F.col("s.part"), _WORD)).alias("w"))
    words = words.select("row", "has", F.lower("w.hit").alias("term"), (F.col("at") + F.col("w.start")).alias("start"), (F.col("at") + F.col("w.end")).alias("end"))
    hits = words.join(_small(levels), "term").where(F.expr("(has & shiftleft(1, kind)) <> 0"))
    # A word that reveals two kinds counts once, with the stronger level; a document bounds its own list.
    hits = hits.groupBy("row", "start", "end").agg(F.max("level").alias("level"))
    span = F.struct("start", F.lit(len(KINDS)).alias("kind"), "end", "level")
    hits = hits.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("term_spans"))
    hits = materialize(hits.withColumnRenamed("row", row), "hits")
    none = F.array().cast("array<struct<start:int,kind:int,end:int,level:int>>")
    return (
        found.join(_small(hits), row, "left")
        .withColumn("term_spans", F.coalesce("term_spans", none))
        .select(*docs.columns, "base_spans", "term_spans")
    )


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in [*KINDS, TERM]])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def all_spans(base: Column, terms: Column) -> Column:
    """Both kinds of spans together, by start, then kind."""
    plain = F.transform(terms, lambda t: F.struct(t["start"].alias("start"), t["kind"].alias("kind"), t["end"].alias("end")))
    return F.array_sort(F.concat(base, plain))


def masked(text: Column, base: Column, terms: Column) -> Column:
    """The text with every span replaced by its kind; removed terms leave nothing behind.

    Of spans that overlap, the first names the place and all their characters go.
    """
    labels = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    put = F.concat(
        F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.element_at(labels, s["kind"] + 1).alias("put"))),
        F.transform(terms, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["level"] == 2, "").otherwise("[WORD]").alias("put"))),
    )
    return _let(F.array_sort(put), lambda spans: _replaced(text, spans, lambda s, at: F.when(s["start"] >= at, s["put"]).otherwise("")))


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same columns, with personal data and the words that reveal it taken out of ``text``."""
    found = find(docs, text)
    clean = masked(F.col(text), F.col("base_spans"), F.col("term_spans"))
    return found.select(*[clean.alias(c) if c == text else F.col(c) for c in docs.columns])
