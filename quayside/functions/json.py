"""JSON checks and edits as Spark expressions.

No Python per row.  The checks are produced as SQL text over a column name /
SQL expression (one parse on the JVM side); the ``Column``-returning helpers
wrap that text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: JSON white space, as a Spark SQL string literal's content
JSON_SPACE = " \\t\\n\\r"


def _sql(x: str) -> str:
    return x if x.startswith("`") or "(" in x or "_" == x[:1] else f"`{x}`"


def present_sql(text: str) -> str:
    """The producer's "given" test: not NULL and not the empty string."""
    t = _sql(text)
    return f"({t} IS NOT NULL AND {t} <> '')"


# fixed values: the tokens of a JSON document, as Java patterns; Python's reader takes NaN and the infinities too
SPACE = r"[ \t\n\r]*+"
STRING = r'"(?:[^"\\\x00-\x1f]++|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+"'
NUMBER = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][-+]?[0-9]++)?+"
WORDS = "true|false|null|NaN|-?Infinity"
#: Levels of nesting that one pattern reads; deeper documents are folded from the inside first.
LEVELS = 3
#: Deeper nesting is refused, as a reader that recurses refuses it.
MOST_LEVELS = 1000


def _containers(key: str, value: str) -> str:
    """Pattern: an array or object whose members match ``value``.  The loops are possessive: linear in the text, no deep stack."""
    def listed(member: str, close: str) -> str:
        return f"{SPACE}(?:{close}|(?:{member}{SPACE}(?:,{SPACE}(?!{close})|(?={close})))++{close})"
    return r"\[" + listed(value, r"\]") + r"|\{" + listed(f"{key}{SPACE}:{SPACE}{value}", r"\}")


def _document(string: str, levels: int, folded: str = "") -> str:
    """Pattern: one complete document, its containers nested up to ``levels`` deep."""
    scalar = f"{string}|{NUMBER}|{WORDS}{folded}"
    value = f"(?:{scalar})"
    for _ in range(levels):
        value = f"(?:{scalar}|{_containers(string, value)})"
    return rf"\A{SPACE}{value}{SPACE}\z"


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def valid_sql(text: str) -> str:
    """Whether the text is one complete JSON document as Python's ``json`` reads it (duplicate
    keys, ``NaN`` and infinities included); never NULL for a given text.

    One pass of one pattern decides nearly all texts.  What it refuses and has more than
    ``LEVELS`` brackets is folded: strings become ``""``, then the innermost containers
    become ``[]``, as often as brackets are nested.
    """
    t = _sql(text)
    flat = f"(?:\"\"|{NUMBER}|{WORDS}|\\[\\])"
    fold = _containers('""', flat)
    bare = f"regexp_replace({t}, {_literal(STRING)}, '\"\"')"
    depth = (f"aggregate(split(regexp_replace({bare}, '[^\\\\[\\\\]{{}}]', ''), ''), named_struct('now', 0, 'most', 0), "
             f"(a, c) -> named_struct('now', a.now + CASE WHEN c IN ('[', '{{') THEN 1 WHEN c = '' THEN 0 ELSE -1 END, "
             f"'most', greatest(a.most, a.now + CASE WHEN c IN ('[', '{{') THEN 1 ELSE 0 END)), a -> a.most)")
    folded = (f"aggregate(sequence(1, least({depth}, {MOST_LEVELS})), {bare}, "
              f"(a, i) -> regexp_replace(a, {_literal(fold)}, '[]'))")
    many = _literal(r"(?:[\[{][^\[{]*+){" + str(LEVELS + 1) + "}")
    return (f"CASE WHEN {t} RLIKE {_literal(_document(STRING, LEVELS))} THEN true "
            f"WHEN {t} RLIKE {many} THEN {folded} RLIKE {_literal(_document('""', 0, '|' + chr(92) + '[' + chr(92) + ']'))} ELSE false END")


def _trimmed(text: str) -> str:
    return f"trim(BOTH '{JSON_SPACE}' FROM {_sql(text)})"


def truthy_sql(text: str) -> str:
    """Python truthiness of a valid JSON document, read from its text."""
    t = _trimmed(text)
    space = "[ \\\\t\\\\n\\\\r]*"
    return (f"CASE substr({t}, 1, 1) WHEN '{{' THEN NOT {t} RLIKE '^\\\\{{{space}\\\\}}$' "
            f"WHEN '[' THEN NOT {t} RLIKE '^\\\\[{space}\\\\]$' WHEN '\"' THEN {t} <> '\"\"' "
            f"WHEN 't' THEN true WHEN 'f' THEN false WHEN 'n' THEN false ELSE try_cast({t} AS DOUBLE) <> 0.0 END")


def object_sql(text: str) -> str:
    """Whether a valid JSON document is an object."""
    return f"substr({_trimmed(text)}, 1, 1) = '{{'"


def is_valid(text: str) -> Column:
    return F.expr(valid_sql(text))


def is_present(text: str) -> Column:
    return F.expr(present_sql(text))


def is_truthy(text: str) -> Column:
    return F.expr(truthy_sql(text))


def is_object(text: str) -> Column:
    return F.expr(object_sql(text))


def compact_sql(text: str) -> str:
    """SQL: a JSON document without white space outside its strings; numbers keep their text."""
    t = _sql(text)
    string = '"[^"\\\\\\\\]*+(?:\\\\\\\\.[^"\\\\\\\\]*+)*+"'
    return (f"CASE WHEN {t} RLIKE '[{JSON_SPACE}]' "
            f"THEN regexp_replace({t}, '({string})|[{JSON_SPACE}]+', '$1') ELSE {t} END")


def append_keys_sql(obj_text: str, values: dict[str, str]) -> str:
    """SQL: a compact JSON object's text with members appended; the object must not
    have them.  The other members stay as they are written."""
    o = _sql(obj_text)
    quote = lambda n: "'" + n.replace("'", "\\'") + "'"
    # to_json of a one-element array, without its brackets, is the escaped string
    members = ", ',', ".join(f"'\"', {quote(n)}, '\":', substr(to_json(array({v})), 2, length(to_json(array({v}))) - 2)"
                             for n, v in values.items())
    return f"concat(CASE WHEN {o} = '{{}}' THEN '{{' ELSE concat(substr({o}, 1, length({o}) - 1), ',') END, {members}, '}}')"


def object_map_sql(obj_text: str) -> str:
    """SQL: a JSON object text as ``map<string,variant>`` (NULL → empty map)."""
    return f"coalesce(from_json({obj_text}, 'map<string,variant>'), CAST(map() AS map<string,variant>))"


def set_map_keys_sql(existing: str, values: dict[str, str]) -> str:
    """SQL: JSON text of ``existing`` (a ``map<string,variant>``) with keys set
    like Python's ``dict.update``: a key that exists keeps its position and
    gets the new value; new keys are appended in the given order.  Nested
    values, numbers and JSON nulls of the other keys are kept.  Pass a column
    so the map is built once: it is referenced twice here."""
    quote = lambda n: "'" + n.replace("'", "\\'") + "'"
    as_variant = lambda v: f"variant_get(to_variant_object(named_struct('v', {v})), '$.v', 'variant')"
    in_place = " ".join(f"WHEN {quote(n)} THEN {as_variant(v)}" for n, v in values.items())
    updated = f"transform_values({existing}, (k, v) -> CASE k {in_place} ELSE v END)"
    new = "map(" + ", ".join(f"{quote(n)}, {as_variant(v)}" for n, v in values.items()) + ")"
    appended = f"map_filter({new}, (k, v) -> NOT array_contains(map_keys({existing}), k))"
    return f"to_json(map_concat({updated}, {appended}))"


def set_object_keys_sql(obj_text: str, values: dict[str, str]) -> str:
    """SQL: set top-level keys of a JSON object text (``dict.update``); see
    ``set_map_keys_sql``.  ``obj_text`` must be a strict JSON object or NULL."""
    return set_map_keys_sql(object_map_sql(obj_text), values)


def set_object_keys(obj_text: str, values: dict[str, str]) -> Column:
    return F.expr(set_object_keys_sql(_sql(obj_text), values))
