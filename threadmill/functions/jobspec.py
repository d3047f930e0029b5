"""SQL expressions that read one field of a job payload (a JSON object as VARIANT).

Arguments name columns (or lambda variables); results are expression text for ``selectExpr``.
Rules for one field stay together, and a whole payload is read in a few projections.
"""

from __future__ import annotations

from ..schemas import KNOWN_BACKENDS, TRUE_WORDS

_EDGE_BLANKS = r"r'(?U)^\s+|\s+$'"
_EMPTY_LIST = "CAST(array() AS array<variant>)"


def _listed(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def given(value: str) -> str:
    """Present and not JSON null."""
    return f"({value} IS NOT NULL AND NOT is_variant_null({value}))"


def text(value: str) -> str:
    return f"try_variant_get({value}, '$', 'string')"


def whole(value: str) -> str:
    return f"try_variant_get({value}, '$', 'bigint')"


def members(value: str) -> str:
    """Members of an object, null for anything else."""
    return f"try_variant_get({value}, '$', 'map<string,variant>')"


def stripped(value: str) -> str:
    return f"regexp_replace({value}, {_EDGE_BLANKS}, '')"


def blank(value: str) -> str:
    return rf"coalesce(NOT rlike({value}, r'(?U)\S'), true)"


def items(value: str) -> str:
    """The members of a list, or the single value as a list of one."""
    return (
        f"coalesce(try_variant_get({value}, '$', 'array<variant>'), "
        f"CASE WHEN {given(value)} THEN array({value}) END, {_EMPTY_LIST})"
    )


def present_items(value: str) -> str:
    return f"filter({items(value)}, v -> NOT is_variant_null(v))"


def target_names(entries: str) -> str:
    """A name for each comma-separated part of the targets that holds anything; null for a
    part that names no subreddit. A part is ``name``, ``r/name`` or a URL with ``/r/name``."""
    parts = rf"""transform(filter(
        flatten(transform({entries}, v -> split({text('v')}, ','))), p -> rlike(p, r'(?U)[^\s/]')),
      p -> regexp_replace({stripped('p')}, r'/+$', ''))"""
    name = rf"""CASE WHEN contains(p, '://') OR startswith(lower(p), 'www.')
        THEN regexp_extract(p, r'/r/([A-Za-z0-9_]+)', 1)
        ELSE {stripped("regexp_replace(p, r'(?i)^/?r/', '')")} END"""
    return rf"""transform(transform({parts}, p -> {name}),
      n -> CASE WHEN rlike(n, r'^[A-Za-z0-9_]{{2,21}}$') THEN lower(n) END)"""


def targets_error(entries: str, names: str) -> str:
    return f"""CASE WHEN exists({entries}, v -> schema_of_variant(v) <> 'STRING') THEN 'target entries must be text'
      WHEN exists({names}, n -> n IS NULL) THEN 'target is not a subreddit name'
      WHEN size({names}) = 0 THEN 'target is required' END"""


def words(value: str) -> str:
    """Terms of a list or of blank-separated text, distinct, in the order given."""
    return rf"""array_distinct(filter(flatten(transform({items(value)},
      v -> split(coalesce({text('v')}, 'None'), r'(?U)\s+'))), w -> w <> ''))"""


def phrase(value: str) -> str:
    """Text with runs of blanks folded to one space; null when blank."""
    return rf"nullif(trim(regexp_replace({text(value)}, r'(?U)\s+', ' ')), '')"


def truth(value: str, default: bool) -> str:
    return f"""CASE WHEN NOT {given(value)} THEN {str(default).lower()}
      WHEN schema_of_variant({value}) = 'STRING' THEN lower({stripped(text(value))}) IN ({_listed(TRUE_WORDS)})
      ELSE coalesce(try_variant_get({value}, '$', 'boolean'), false) END"""


def positive_whole_error(value: str, number: str, field: str, most: int) -> str:
    return f"""CASE WHEN NOT {given(value)} OR {blank(text(value))} THEN NULL
      WHEN {number} IS NULL THEN '{field} must be a whole number'
      WHEN {number} <= 0 THEN '{field} must be greater than 0'
      WHEN {number} > {most} THEN '{field} is too large' END"""


def backends(value: str) -> str:
    listed = f"transform(try_variant_get({value}, '$', 'array<variant>'), v -> {text('v')})"
    return f"""array_distinct(filter(transform(
      coalesce({listed}, split({text(value)}, ','), array()), b -> {stripped('b')}), b -> b <> ''))"""


def unknown_backend(names: str, message: str) -> str:
    return f"CASE WHEN exists({names}, b -> b NOT IN ({_listed(KNOWN_BACKENDS)})) THEN '{message}' END"


def backend_settings_error(value: str, overrides: str) -> str:
    """``overrides`` are the :func:`members` of the settings."""
    return f"""CASE WHEN NOT {given(value)} THEN NULL
      WHEN {overrides} IS NULL THEN 'backendSettings must be an object'
      ELSE coalesce({unknown_backend(f'map_keys({overrides})', 'unknown backend in backendSettings')},
        CASE WHEN exists(map_values({overrides}), v -> {members('v')} IS NULL)
          THEN 'backendSettings entries must be objects' END) END"""

