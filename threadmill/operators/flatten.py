"""Nested reply documents -> flat comment records."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..session import fresh_dir, materialize
from .structure import CUT, ODD, ROOT, UNSOUND, cut_documents, text_heads, text_pieces, text_states
from .threads import resolve_forest

# Levels taken apart in one pass; few real threads are nested deeper.
LEVELS = 12
# Documents that the reader refuses are cut at every record, so that no record is parsed and copied
# again for each level above it; what a piece holds is itself and marks.
EVERY_RECORD = 1
PIECE_LEVELS = 2
# So are documents with more lists than this, which may be as deep: passes would copy them again and again.
MANY_LISTS = 50

# The rules of nested replies, for a node ``n``.
_BARE = "try_variant_get(n, '$.replies', 'array<variant>')"
_VALUE = "try_variant_get(n, '$.{0}', 'variant')"
# Neither null, nor empty text, nor zero, nor false (for values that do not nest).
_HOLDS_SCALAR = f"""coalesce(
  {_VALUE} IS NOT NULL AND NOT is_variant_null({_VALUE}) AND try_variant_get(n, '$.{{0}}', 'string') <> ''
  AND (schema_of_variant({_VALUE}) = 'STRING'
    OR try_variant_get(n, '$.{{0}}', 'string') NOT IN ('0', '0.0', 'false', '[]', '{{{{}}}}')), false)"""
# ``replies`` holds something, so ``children`` is not looked at.
_HAS_REPLIES = f"""(coalesce(size({_BARE}) > 0, false)
  OR coalesce(size(try_variant_get(n, '$.replies', 'map<string,variant>')) > 0, false)
  OR {_HOLDS_SCALAR.format('replies')})"""
# A list of replies stands for itself, an object must be an envelope. The usual form comes
# first: the other tests only run for nodes without a plain list.
_REPLIES = f"""coalesce(
  CASE WHEN size({_BARE}) > 0 THEN {_BARE} END,
  CASE WHEN {_HAS_REPLIES} THEN try_variant_get(n, '$.replies.data', 'array<variant>')
    ELSE coalesce(try_variant_get(n, '$.children', 'array<variant>'),
      try_variant_get(n, '$.children.data', 'array<variant>')) END,
  CAST(array() AS array<variant>))"""
_IS_COMMENT = f"""({_HOLDS_SCALAR.format('id')}
  OR ({_VALUE.format('body')} IS NOT NULL AND NOT is_variant_null({_VALUE.format('body')})))"""
# The record without its replies; ``children`` goes only if it was used as such.
_FIELDS = "try_variant_get(n, '$', 'map<string,variant>')"
_OWN = f"""to_json(CASE
  WHEN {_VALUE.format('children')} IS NOT NULL AND {_HAS_REPLIES}
  THEN map_filter({_FIELDS}, (k, v) -> k <> 'replies')
  ELSE map_filter({_FIELDS}, (k, v) -> k NOT IN ('replies', 'children')) END)"""


# The same rules for a record that is at hand as ``m``, the map of its members.
def _holds_scalar(member: str) -> str:
    said = f"try_variant_get({member}, '$', 'string')"
    return f"""coalesce({member} IS NOT NULL AND NOT is_variant_null({member}) AND {said} <> ''
  AND ({said} NOT IN ('0', '0.0', 'false', '[]', '{{}}') OR schema_of_variant({member}) = 'STRING'), false)"""


_M_BARE = "try_variant_get(m['replies'], '$', 'array<variant>')"
# Most records without replies have none or an empty text there, which is told at once.
_M_HAS_REPLIES = f"""(CASE WHEN m['replies'] IS NULL OR try_variant_get(m['replies'], '$', 'string') = '' THEN false
  ELSE coalesce(size({_M_BARE}) > 0, false)
  OR coalesce(size(try_variant_get(m['replies'], '$', 'map<string,variant>')) > 0, false)
  OR {_holds_scalar("m['replies']")} END)"""
_M_REPLIES = f"""coalesce(
  CASE WHEN size({_M_BARE}) > 0 THEN {_M_BARE} END,
  CASE WHEN {_M_HAS_REPLIES} THEN try_variant_get(m['replies'], '$.data', 'array<variant>')
    ELSE coalesce(try_variant_get(m['children'], '$', 'array<variant>'),
      try_variant_get(m['children'], '$.data', 'array<variant>')) END,
  CAST(array() AS array<variant>))"""
_M_IS_COMMENT = f"((m['body'] IS NOT NULL AND NOT is_variant_null(m['body'])) OR {_holds_scalar("m['id']")})"
_M_OWN = f"""to_json(CASE WHEN m['children'] IS NOT NULL AND {_M_HAS_REPLIES}
  THEN map_filter(m, (k, v) -> k <> 'replies') ELSE map_filter(m, (k, v) -> k NOT IN ('replies', 'children')) END)"""


def envelope_items(payload: Column) -> Column:
    """Records of ``{"data": [...]}`` or of a bare list; no records for anything else."""
    return F.coalesce(
        F.try_variant_get(payload, "$", "array<variant>"),
        F.try_variant_get(payload, "$.data", "array<variant>"),
        F.array().cast("array<variant>"),
    )


def _refused(df: DataFrame, column: str) -> DataFrame:
    """Rows whose JSON the reader does not take as a whole."""
    return df.filter(F.col(column).isNotNull() & F.try_parse_json(column).isNull())


class _Pieces:
    """Refused documents, stored as ``rows`` with a number each, and the pieces of the sound ones."""

    def __init__(self, refused: DataFrame, column: str, every: int | None = None):
        self.rows = materialize(refused.withColumn("_doc", F.monotonically_increasing_id()), "refused")
        self.mark = _mark()
        docs = self.rows.select(F.col("_doc").alias("doc"), F.col(column).alias("text"))
        self.all = materialize(cut_documents(docs, "text", self.mark, every), "pieces")
        self.broken = self.all.filter(F.try_parse_json("text").isNull()).select(F.col("doc").alias("_doc")).distinct()
        self.sound = self.all.join(self.broken, F.col("doc") == F.col("_doc"), "left_anti")


def _bound(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """``keep`` and the column, made once a row: no filter or later step makes it again."""
    return df.select(*keep, F.explode(F.array(column)).alias(column))


# The reader's own rules, but for the depth; a text that is no JSON leaves itself in ``broken``.
_STREAM = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken", "maxNestingDepth": "2000000000",
           "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _is_json(text: Column) -> Column:
    """The text is one JSON value, however deep; read token by token, nothing of it is kept."""
    member = F.concat(F.lit('{"text":'), text, F.lit("}"))
    return F.from_json(member, "none int, broken string", _STREAM)["broken"].isNull()


def _state(state: Column, text: Column) -> Column:
    """``state`` of a text with JSON in its place: what is cut and no JSON is unsound."""
    return F.when(state != CUT, state).when(_is_json(text), CUT).when(F.is_valid_utf8(text), UNSOUND).otherwise(ODD)


def _mark() -> str:
    return f"cut_{uuid.uuid4().hex[:12]}"


def unreadable_documents(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """Documents without records: ``keep``, their ``characters`` and the ``reason``.

    A document that the JSON reader refuses is looked at bracket by bracket, whatever its depth or size; those
    that are no JSON or have a piece that is refused as well are listed. :func:`flatten_replies` has no
    records for them, so a run that uses it keeps this table beside its result.

    Documents are told where they are; only odd ones (see ``structure``) are stored and cut into pieces.
    """
    bound, text = _bound(df, column, keep), F.col(column)
    told = _refused(bound, column).withColumn("_state", text_states(text))
    told = told.select(*keep, column, F.explode(F.array(_state(F.col("_state"), text))).alias("_state"))
    odd = Observation()
    listed = materialize(
        _listed(told, column, [*keep, "_state"], F.col("_state") == UNSOUND).filter(F.col("_state") != CUT), "unreadable", None, odd,
        F.count_if(F.col("_state") == ODD).alias("n"),
    )
    sure = listed.filter(F.col("_state") == UNSOUND).drop("_state", "_hash")
    if not odd.get["n"]:
        return sure
    pieces = _Pieces(_of_texts(_refused(bound, column), column, listed.filter(F.col("_state") == ODD)), column)
    return sure.unionByName(_listed(pieces.rows.join(pieces.broken, "_doc", "left_semi"), column, keep, F.lit(True)).drop("_hash"))


def _listed(df: DataFrame, column: str, names: list[str], wanted: Column) -> DataFrame:
    """``names`` and, where ``wanted``, characters and reason of documents without records."""
    text = F.col(column)
    sound = F.get_json_object(text, "$").isNotNull()
    balanced = F.rlike(F.rtrim(text), F.lit(r"[\]}]$")) & F.rlike(text, F.lit(r"^\s*[\[{]"))
    reason = F.when(sound, "too large").when(balanced, "too deep or not JSON").otherwise("not JSON")
    return df.select(
        *names, F.xxhash64(text).alias("_hash"),
        F.when(wanted, F.char_length(text).cast("bigint")).alias("characters"), F.when(wanted, reason).alias("reason"),
    )


def _of_texts(df: DataFrame, column: str, listed: DataFrame) -> DataFrame:
    """The rows of ``df`` whose text has a ``_hash`` that is listed."""
    hashes = listed.select("_hash").distinct()
    return df.withColumn("_hash", F.xxhash64(column)).join(hashes, "_hash", "left_semi").drop("_hash")


# A text that nests deeper than the reader goes has at least so many characters.
DEEP_CHARACTERS = 1_000


def read_pages(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """``keep``, whether the text was ``_sent``, and ``_page``, the envelope parsed.

    An envelope that the reader refuses has a ``_state``; its records are read with what lies deep in them cut out.
    ``_page`` is null for what is no JSON and for odd texts, which have a ``_hash``; see :func:`odd_items`.
    """
    text, mark = F.col(column), _mark()
    read = _bound(df, column, keep).select(*keep, column, F.try_parse_json(text).alias("_whole"))
    deep = F.when(text.isNotNull() & F.col("_whole").isNull() & (F.length(column) >= DEEP_CHARACTERS), text)
    read = read.withColumn("_deep", F.explode(F.array(deep))).withColumn("_cut", text_heads(F.col("_deep"), mark))
    state = F.when(F.col("_deep").isNotNull(), _state(F.col("_cut.state"), F.col("_deep")))
    read = read.select(*keep, column, "_whole", "_cut", F.explode(F.array(state)).alias("_state"))
    head = F.when(F.col("_state") == CUT, F.try_parse_json("_cut.head"))
    return read.select(*keep, F.coalesce("_whole", head).alias("_page"), F.col(column).isNotNull().alias("_sent"), "_state",
                       F.when(F.col("_state") == ODD, F.xxhash64(column)).alias("_hash"))


def odd_items(df: DataFrame, column: str, keep: list[str], listed: DataFrame) -> DataFrame:
    """``keep``, ``place`` and ``item`` of the odd envelopes ``listed`` (``_hash``) that are sound.

    The items are the records with what lies deep in them cut out; see :func:`envelope_items`.
    """
    refused = _refused(_bound(df, column, keep).filter(F.length(column) >= DEEP_CHARACTERS), column)
    pieces = _Pieces(_of_texts(refused, column, listed), column)
    text = F.try_parse_json("text")
    roots = pieces.sound.filter(F.col("piece") == ROOT).select("doc", F.posexplode_outer(envelope_items(text)).alias("place", "own"))
    roots = roots.withColumn("piece", F.try_variant_get("own", f"$.{pieces.mark}", "string"))
    parts = pieces.sound.select("doc", "piece", text.alias("whole"))
    names = pieces.rows.select(F.col("_doc").alias("doc"), *keep)
    return roots.join(parts, ["doc", "piece"], "left").join(names, "doc").select(*keep, "place", F.coalesce("whole", "own").alias("item"))


def flatten_replies(trees: DataFrame, tree: str, keep: list[str] | None = None) -> DataFrame:
    """Every comment of the nested documents in JSON column ``tree``, one per row.

    Result: ``keep`` columns, nesting ``level`` and ``raw``, the record without its replies.
    Replies are read from ``replies``, else ``children``, as a list or an envelope.

    A pass takes ``LEVELS`` levels apart inside each document row; only documents nested
    deeper than that come back for another pass, each pass over a written table. Documents
    that the reader refuses as a whole are cut at every record, and their records are read one by one.
    """
    keep = keep or []
    taken = Observation()
    trees = _bound(trees, tree, keep)
    lists = F.octet_length(tree) - F.octet_length(F.replace(F.col(tree), F.lit("["), F.lit("")))
    whole = F.when(lists <= MANY_LISTS, F.try_parse_json(tree))
    parsed = trees.select(*keep, whole.alias("_parsed"), F.col(tree).isNotNull().alias("_there"))
    parsed = parsed.observe(taken, F.count_if(F.col("_there") & F.col("_parsed").isNull()).alias("refused"))
    docs = parsed.select(*keep, F.lit(0).alias("base"), envelope_items(F.col("_parsed")).alias("level0"))
    found = _passes(docs, keep, "flatten")
    if not taken.get["refused"]:
        return found
    return found.unionByName(_flatten_deep(trees.filter(F.col(tree).isNotNull() & whole.isNull()), tree, keep))


def _passes(docs: DataFrame, keep: list[str], label: str, mark: str | None = None) -> DataFrame:
    """All records of documents (``keep``, ``base``, ``level0``), and where marks stand among the replies."""
    levels = PIECE_LEVELS if mark else LEVELS
    folder = fresh_dir(docs.sparkSession, label)
    names = [*keep, "level", "raw", *(["cut"] if mark else [])]
    found: list[DataFrame] = []
    while True:
        deeper = Observation()
        part = materialize(
            _take_levels(docs, keep, levels, mark), f"pass={len(found)}", folder, deeper,
            F.count_if(F.col("rest").isNotNull()).alias("n"),
        )
        found.append(part.filter(F.col("rest").isNull()).select(*names))
        if not deeper.get["n"]:
            return reduce(lambda a, b: a.unionByName(b), found)
        docs = part.filter(F.col("rest").isNotNull()).select(
            *keep, F.col("level").alias("base"), F.col("rest").alias("level0")
        )


def _take_levels(docs: DataFrame, keep: list[str], levels: int, mark: str | None = None) -> DataFrame:
    """The records of the next levels of each document, and what lies below them (``rest``)."""
    for i in range(levels):
        docs = docs.selectExpr(
            "*", f"flatten(transform(level{i}, n -> {_REPLIES})) AS level{i + 1}"
        )
    cut = f"try_variant_get(n, '$.{mark}', 'string')" if mark else "CAST(NULL AS string)"
    wanted = f"({_IS_COMMENT} OR {cut} IS NOT NULL)" if mark else _IS_COMMENT
    records = [
        f"""transform(filter(level{i}, n -> {wanted}), n -> named_struct(
          'level', base + {i}, 'raw', {_OWN}, 'cut', {cut}, 'rest', CAST(NULL AS array<variant>)))"""
        for i in range(levels)
    ]
    below = f"""array(named_struct('level', base + {levels}, 'raw', CAST(NULL AS string), 'cut', CAST(NULL AS string),
      'rest', CASE WHEN size(level{levels}) > 0 THEN level{levels} END))"""
    return docs.selectExpr(*keep, f"inline(concat({', '.join(records)}, {below}))").filter(
        F.col("raw").isNotNull() | F.col("rest").isNotNull()
    )


def _flatten_deep(docs: DataFrame, tree: str, keep: list[str]) -> DataFrame:
    """The records of documents cut at every record, each read where its document is.

    A document is plain if all its pieces are JSON and all that is cut out of it stands among the replies of the
    record around, so that every piece is a record of the tree. That is told piece by piece. Others are left to
    :func:`_flatten_pieces`.
    """
    mark = _mark()
    cut = text_pieces(docs.select(*keep, F.xxhash64(tree).alias("_hash"), tree), tree, mark, EVERY_RECORD)
    read = cut.select(*keep, "_hash", "level", "kids", F.try_parse_json("text").alias("n"))
    read = read.select(*keep, "_hash", "level", "kids", "n", F.try_variant_get("n", "$", "map<string,variant>").alias("m"))

    def holds(path: str) -> str:
        return f"try_variant_get(n, '{path}[0].{mark}', 'string') IS NOT NULL"

    # All objects in lists of replies are cut out. So if a piece's marks stand in one list and replies begin with a
    # mark, the replies are that list.
    replied = f"""{holds('$.replies')} OR {holds('$.replies.data')}
      OR (({holds('$.children')} OR {holds('$.children.data')}) AND NOT {_M_HAS_REPLIES})"""
    plain = F.expr(f"""coalesce(n IS NOT NULL AND CASE WHEN kids > 0 AND level < 0 THEN {holds('$')} OR {holds('$.data')}
      WHEN kids > 0 THEN {replied} END, false)""")
    nothing = (F.col("kids") == 0) & (F.size(F.when(F.col("level") < 0, envelope_items(F.col("n"))).otherwise(F.expr(_M_REPLIES))) == 0)
    plain = plain | F.coalesce(F.col("n").isNotNull() & nothing, F.lit(False))
    odd = Observation()
    rows = materialize(
        read.select(
            *keep, "_hash", "level", F.expr(f"CASE WHEN level >= 0 AND {_M_IS_COMMENT} THEN {_M_OWN} END").alias("raw"),
            (~plain).alias("_odd"),
        ), "records", None, odd, F.count_if("_odd").alias("n"),
    )
    found = rows.filter(F.col("raw").isNotNull())
    if not odd.get["n"]:
        return found.select(*keep, "level", "raw")
    listed = materialize(rows.filter("_odd").select("_hash").distinct(), "odd")
    found = found.join(listed, "_hash", "left_anti").select(*keep, "level", "raw")
    return found.unionByName(_flatten_pieces(_Pieces(_of_texts(docs, tree, listed), tree, EVERY_RECORD), keep))


def _flatten_pieces(pieces: _Pieces, keep: list[str]) -> DataFrame:
    """The records of documents in pieces.

    Marks that stand among replies lead from piece to piece; a piece counts if such a way leads
    to it from its document's first one. Others were cut out of a record's own data, and are put
    back there.
    """
    parsed = F.try_parse_json("text")
    items = F.when(F.col("piece") == ROOT, envelope_items(parsed)).otherwise(F.array(parsed))
    docs = pieces.sound.select("doc", "piece", F.col("level").alias("base"), items.alias("level0"))
    found = _passes(docs, ["doc", "piece"], "flatten-pieces", pieces.mark)
    records = found.filter(F.col("cut").isNull())
    links = found.filter(F.col("cut").isNotNull()).select("doc", F.col("cut").alias("piece"), F.col("piece").alias("around"))
    nodes = pieces.sound.select("doc", "piece").join(links, ["doc", "piece"], "left")
    if not nodes.filter((F.col("piece") != ROOT) & F.col("around").isNull()).isEmpty():
        doc = F.col("doc").cast("string")
        way = nodes.select(
            doc.alias("subreddit"), F.col("piece").alias("id"), F.concat(F.lit("t1_"), "around").alias("parent_id")
        )
        reached = resolve_forest(way).filter(F.col("root_id") == ROOT)
        reached = reached.select(F.col("subreddit").cast("bigint").alias("doc"), F.col("id").alias("piece"))
        records = _put_back(records.join(reached, ["doc", "piece"], "left_semi"), pieces)
    names = pieces.rows.select(F.col("_doc").alias("doc"), *keep)
    return records.select("doc", "level", "raw").join(names, "doc").select(*keep, "level", "raw")


def _put_back(records: DataFrame, pieces: _Pieces) -> DataFrame:
    """Records with the text of pieces in place of the marks that are left in them."""
    whole, marked = [], F.contains("raw", F.lit(pieces.mark))
    records = materialize(records.select("doc", "level", "raw"), "records")
    while True:
        whole.append(records.filter(~marked))
        rows = materialize(records.filter(marked).withColumn("row", F.monotonically_increasing_id()), "marked")
        if rows.isEmpty():
            break
        pattern = rf'\{{"{pieces.mark}":"([0-9]+:[0-9]+)"\}}'
        names = F.explode(F.array_distinct(F.regexp_extract_all("raw", F.lit(pattern), F.lit(1)))).alias("piece")
        texts = rows.select("row", "doc", names).join(pieces.sound.select("doc", "piece", "text"), ["doc", "piece"])
        place = F.concat(F.lit(f'{{"{pieces.mark}":"'), "piece", F.lit('"}'))
        texts = texts.groupBy("row").agg(F.collect_list(F.struct(place.alias("mark"), "text")).alias("texts"))
        raw = F.aggregate("texts", F.col("raw"), lambda out, t: F.replace(out, t["mark"], t["text"]))
        records = materialize(rows.join(texts, "row").select("doc", "level", raw.alias("raw")), "records")
    out = reduce(lambda a, b: a.unionByName(b), whole)
    return out.withColumn("raw", F.coalesce(F.to_json(F.try_parse_json("raw")), F.col("raw")))
