"""Record checks: allowed values, types by example, contracts; rejects are kept aside."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, DataType, DecimalType, DoubleType, FloatType, IntegralType, MapType, StructType,
)

# ---- allowed values -------------------------------------------------------------------------


def validate_enums(df: DataFrame, allowed: Mapping[str, Sequence], columns: Sequence[str]) -> DataFrame:
    """Adds ``bad_keys``: the columns with a value that is not allowed.

    A null column is an absent key; a column without a list of allowed values is always bad.
    """
    checks = []
    for name in columns:
        value = F.col(name)
        fine = value.isin(*allowed[name]) if allowed.get(name) else F.lit(False)
        checks.append(F.when(value.isNotNull() & ~fine, F.lit(name)))
    return df.withColumn("bad_keys", F.array_compact(F.array(*checks)))


# ---- types by example -----------------------------------------------------------------------


# How the type of a JSON value of each kind reads as a variant. Integers too long
# for 64 bits are decimals without a scale.
_LONG_INT = r"\((?:19|[23]\d),0\)"
_TYPE_TEXTS = {
    "int": rf"BIGINT|DECIMAL{_LONG_INT}", "float": rf"DECIMAL(?!{_LONG_INT})|DOUBLE|FLOAT", "str": "STRING",
    "bool": "BOOLEAN", "null": "VOID", "list": "ARRAY", "dict": "OBJECT",
}


def _is(type_text: Column, kinds: Sequence[str]) -> Column:
    return type_text.rlike("^(?:" + "|".join(_TYPE_TEXTS[kind] for kind in kinds) + ")")


def _all_are(type_texts: Column, kind: str) -> Column:
    return F.forall(type_texts, lambda text: _is(text, [kind]))


def _accepted(example) -> list[str]:
    """Kinds that pass where the example has the given value. A bool is an int, an int a float."""
    if isinstance(example, str):
        return ["str"]
    if isinstance(example, bool):
        return ["bool"]
    if isinstance(example, int):
        return ["int", "bool"]
    if isinstance(example, float):
        return ["float", "int", "bool"]
    if isinstance(example, Mapping):
        return ["dict"]
    if isinstance(example, (list, tuple)):
        return ["list"]
    return ["null"]


def _path(*keys: str) -> str:
    quoted = [key.replace("\\", "\\\\").replace('"', '\\"') for key in keys]
    return "$" + "".join(f'["{key}"]' for key in quoted)


def _member(doc: Column, *keys: str) -> Column:
    return F.try_variant_get(doc, _path(*keys), "variant")


# What parts the keys of a path, and stands for that character, and for itself, inside a key.
_PART, _MARK = "\u0001", "\u0002"


def _written(key: str) -> str:
    return key.replace(_MARK, _MARK + "b").replace(_PART, _MARK + "a")


def _written_key(key: Column) -> Column:
    return F.replace(F.replace(key, F.lit(_MARK), F.lit(_MARK + "b")), F.lit(_PART), F.lit(_MARK + "a"))


def _rules(example: Mapping, above: tuple[str, ...] = ()) -> dict[str, tuple[str, tuple[str, ...]]]:
    """For each path of the example the kinds that pass there and, where it has a list, the kinds of the items."""
    rules: dict[str, tuple[str, tuple[str, ...]]] = {}
    for key, value in example.items():
        path = (*above, _written(key))
        items = tuple(_accepted(value[0])) if isinstance(value, (list, tuple)) and value else ()
        rules[_PART.join(path)] = (" ".join(_accepted(value)), items)
        if isinstance(value, Mapping):
            rules |= _rules(value, path)
    return rules


def _lookup(table: Mapping[str, str]) -> Callable[[Column], Column]:
    """Finds texts in a fixed table: by their checksum in one of as many small maps as the table has entries."""
    n = max(1, len(table))
    maps: list[list[Column]] = [[] for _ in range(n)]
    for key, value in table.items():
        maps[zlib.crc32(key.encode()) % n] += [F.lit(key), F.lit(value)]
    kind = "map<string,string>"
    held = F.array(*[(F.create_map(*m) if m else F.create_map()).cast(kind) for m in maps])
    return lambda key: F.element_at(F.get(held, (F.crc32(key) % n).cast("int")), key)


def _entry(path: Column, top: Column, value: Column, rule_of: Callable[[Column], Column]) -> Column:
    return F.struct(
        path.alias("path"), top.alias("top"), value.alias("value"), rule_of(path).alias("rule"),
        F.schema_of_variant(value).alias("type"),
    )


def _offends(entry: Column, rules: Mapping[str, tuple[str, tuple[str, ...]]]) -> Column:
    """Whether a value has another type than its rule admits; null values and those without a rule do not offend."""
    rule, type_text = entry["rule"], entry["type"]
    fine = F.lit(True)
    for name, (kinds, items) in rules.items():
        good = _is(type_text, kinds.split())
        if kinds == "list":
            # a list must have items, all of one type, the type of the example's items
            item_types = F.transform(F.try_variant_get(entry["value"], "$", "array<variant>"), F.schema_of_variant)
            alike = reduce(Column.__or__, [_all_are(item_types, kind) for kind in items], F.lit(False))
            good = good & F.coalesce((F.size(item_types) > 0) & alike, F.lit(False))
        fine = F.when(rule == name, good).otherwise(fine)
    return F.coalesce(rule.isNotNull() & (type_text != "VOID") & ~fine, F.lit(False))


def _entries_below(entries: Column, rule_of: Callable[[Column], Column], dicts: Sequence[str]) -> Column:
    """The entries of the documents that some entries hold where the example has a document."""
    def members(entry: Column) -> Column:
        inner = F.map_entries(F.try_variant_get(entry["value"], "$", "map<string, variant>"))
        below = F.transform(inner, lambda e: _entry(
            F.concat(entry["path"], F.lit(_PART), _written_key(e["key"])), entry["top"], e["value"], rule_of))
        return F.coalesce(below, F.filter(F.array(entry), lambda _: F.lit(False)))

    return F.flatten(F.transform(F.filter(entries, lambda e: e["rule"].isin(*dicts)), members))


def validate_records(
    df: DataFrame,
    json_col: str,
    example: Mapping,
    drop_offending: bool = False,
    drop_unknown: bool = False,
) -> DataFrame:
    """Checks JSON documents against an example document whose value types are the contract.

    Adds ``offending_keys`` (a wrong type somewhere under the key), ``unknown_keys`` (not in the example), both sorted, and
    ``payload``, the document without the keys to drop. A text that is no JSON object has null in all three.

    A document is taken apart once, a level at a time as deep as the example goes, and each of its values finds its rule by
    its path. What the example has and a document has not costs nothing. Everything stays row-local.
    """
    rules = _rules(example)
    names = {rule: f"r{i}" for i, rule in enumerate(dict.fromkeys(rules.values()))}
    rule_of = _lookup({path: names[rule] for path, rule in rules.items()})
    dicts = [name for (kinds, _), name in names.items() if kinds == "dict"]
    depth = 1 + max((path.count(_PART) for path in rules), default=0)
    checked = df.withColumn("_doc", F.try_parse_json(json_col)).withColumn("_entries", F.col("_doc").try_cast("map<string, variant>"))
    levels = [f"_level{i}" for i in range(depth)]
    top = F.transform(F.map_entries("_entries"), lambda e: _entry(_written_key(e["key"]), e["key"], e["value"], rule_of))
    for i, level in enumerate(levels):
        checked = checked.withColumn(level, _entries_below(F.col(levels[i - 1]), rule_of, dicts) if i else top)
    by_name = {name: rule for rule, name in names.items()}
    # an offence at any depth marks the top-level key
    bad = [F.transform(F.filter(level, lambda e: _offends(e, by_name)), lambda e: e["top"]) for level in levels]
    unknown = F.transform(F.filter(levels[0], lambda e: e["rule"].isNull()), lambda e: e["top"])
    checked = checked.withColumns({
        "offending_keys": F.sort_array(F.array_distinct(F.concat(*bad))),
        "unknown_keys": F.sort_array(unknown),
    })
    none = F.array().cast("array<string>")
    dropped = [F.coalesce("offending_keys", none)] * drop_offending + [F.coalesce("unknown_keys", none)] * drop_unknown
    kept = F.map_filter("_entries", lambda k, _: ~F.array_contains("_dropped", k))
    payload = F.when(F.size("_dropped") == 0, F.to_json("_doc")).otherwise(F.to_json(kept))
    return (
        checked.withColumn("_dropped", F.concat(none, *dropped))
        .withColumn("payload", F.when(F.col("_entries").isNotNull(), payload))
        .drop("_doc", "_dropped", "_entries", *levels)
    )


# ---- contracts ------------------------------------------------------------------------------

# The type names of the contract language and the kinds they admit.
_CONTRACT_KINDS = {
    "integer": ["int"], "number": ["int", "float"], "string": ["str"], "boolean": ["bool"],
    "array": ["list"], "object": ["dict"], "null": ["null"],
}


def validate_contract(df: DataFrame, json_col: str, contract: Mapping) -> DataFrame:
    """Checks JSON documents against required keys and property types.

    Adds ``missing_keys``, ``mistyped_keys`` and ``valid``.
    """
    doc = F.col("_doc")
    keys = F.map_keys(doc.try_cast("map<string, variant>"))
    rules = {
        key: [rule["type"]] if isinstance(rule["type"], str) else rule["type"]
        for key, rule in contract.get("properties", {}).items() if "type" in rule
    }
    types = {f"_type{i}": F.schema_of_variant(_member(doc, key)) for i, key in enumerate(rules)}
    mistyped = []
    for i, (key, names) in enumerate(rules.items()):
        type_text, kinds = F.col(f"_type{i}"), [kind for name in names for kind in _CONTRACT_KINDS[name]]
        good = _is(type_text, kinds)
        if "int" in kinds and "float" not in kinds:
            # 2.0 is an integer in this contract language
            number = F.try_variant_get(doc, _path(key), "double")
            good = good | (_is(type_text, ["float"]) & (number == F.floor(number)))
        mistyped.append(F.when(~good, F.lit(key)))
    required = F.array(*[F.lit(k) for k in contract.get("required", [])]).cast("array<string>")
    checked = df.withColumn("_doc", F.try_parse_json(json_col)).withColumns(types).withColumns({
        "missing_keys": F.array_except(required, F.coalesce(keys, F.array().cast("array<string>"))),
        "mistyped_keys": F.array_compact(F.array(*mistyped)).cast("array<string>"),
        "_is_object": keys.isNotNull(),
    })
    valid = F.col("_is_object") & (F.size("missing_keys") == 0) & (F.size("mistyped_keys") == 0)
    return checked.withColumn("valid", valid).drop("_doc", "_is_object", *types)


# ---- common ---------------------------------------------------------------------------------


def mark_rejects(df: DataFrame, reasons: Mapping[str, Column]) -> DataFrame:
    """Adds ``reject_reasons``, the names of the checks a row failed, in one pass.

    Each reason is true for a bad row; null counts as not bad.
    """
    failed = [F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in reasons.items()]
    return df.withColumn("reject_reasons", F.array_compact(F.array(*failed)))


def split_rejects(df: DataFrame, reasons: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with their reasons, as two tables.

    Each is computed from the input when used; write the marked rows once if checks are costly.
    """
    marked = mark_rejects(df, reasons)
    clean = F.size("reject_reasons") == 0
    return marked.where(clean).drop("reject_reasons"), marked.where(~clean)


def drop_null_keys(record: Column) -> Column:
    return F.map_filter(record, lambda _, v: v.isNotNull())


def _json_text(text: Column) -> Column:
    """A text in quotes; everything beyond printable ASCII is escaped, in lower-case hex."""
    def escape(unit: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(unit), 4, "0")))

    def written(char: Column) -> Column:
        point = F.ascii(char)
        rest = point - 0x10000
        pair = F.concat(escape(F.lit(0xD800) + F.shiftright(rest, 10)), escape(F.lit(0xDC00) + rest.bitwiseAND(0x3FF)))
        short = F.when(char == '"', '\\"').when(char == "\\", "\\\\")
        for plain, letter in (("\b", "b"), ("\f", "f"), ("\n", "n"), ("\r", "r"), ("\t", "t")):
            short = short.when(char == plain, "\\" + letter)
        plain = (point >= 32) & (point <= 126)
        return short.when(plain, char).when(point > 0xFFFF, pair).otherwise(escape(point))

    odd = text.rlike(r'[^ -~]|["\\]')
    chars = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), written)
    return F.concat(F.lit('"'), F.when(odd, F.array_join(chars, "")).otherwise(text), F.lit('"'))


def _json_float(number: Column) -> Column:
    """A float with the fewest digits, as an exponent below 1e-4 and from 1e16 on.

    The digits are Spark's, which writes the least subnormal numbers with two of them.
    """
    text = F.abs(number).cast("string")
    mantissa = F.substring_index(text, "E", 1)
    whole = F.substring_index(mantissa, ".", 1)
    digits = F.regexp_replace(F.replace(mantissa, F.lit("."), F.lit("")), r"^0+(?=\d)|0+$", "")
    given = F.when(text.contains("E"), F.substring_index(text, "E", -1).cast("int")).otherwise(0)
    leading = F.length(F.regexp_extract(F.replace(mantissa, F.lit("."), F.lit("")), r"^(0*)", 1))
    power = given + F.length(whole) - 1 - leading  # of the first digit
    n = F.length(digits)
    positional = (
        F.when(power < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits))
        .when(n <= power + 1, F.concat(digits, F.repeat(F.lit("0"), power + 1 - n), F.lit(".0")))
        .otherwise(F.concat(F.substring(digits, F.lit(1), power + 1), F.lit("."), F.substring(digits, power + 2, n)))
    )
    fraction = F.when(n > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), n))).otherwise("")
    exponent = F.concat(
        F.substring(digits, 1, 1), fraction, F.lit("e"), F.when(power < 0, "-").otherwise("+"),
        F.when(F.abs(power) < 10, "0").otherwise(""), F.abs(power).cast("string"))
    finite = F.when(number == 0, "0.0").when((power >= -4) & (power < 16), positional).otherwise(exponent)
    negative = (number < 0) | number.cast("string").startswith("-")
    return F.when(F.isnan(number), "NaN").otherwise(F.concat(
        F.when(negative, "-").otherwise(""), F.when(text == "Infinity", "Infinity").otherwise(finite)))


def _json_value(col: Column, kind: DataType) -> Column:
    """A value of any type as JSON; what JSON has no form for, such as a time, is the text Spark writes for it."""
    if isinstance(kind, (DoubleType, FloatType)):
        text = _json_float(col)
    elif isinstance(kind, (IntegralType, DecimalType, BooleanType)):
        text = col.cast("string")
    elif isinstance(kind, ArrayType):
        items = F.transform(col, lambda item: _json_value(item, kind.elementType))
        text = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    elif isinstance(kind, StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        text = F.when(col.isNotNull(), _json_object([(f.name, _json_value(col[f.name], f.dataType)) for f in fields]))
    elif isinstance(kind, MapType):
        entries = F.transform(F.array_sort(F.map_keys(col)), lambda key: F.concat(
            _json_text(key.cast("string")), F.lit(": "), _json_value(F.element_at(col, key), kind.valueType)))
        text = F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}"))
    else:
        text = _json_text(F.base64(col) if isinstance(kind, BinaryType) else col.cast("string"))
    return F.coalesce(text, F.lit("null"))


def _json_object(members: Sequence[tuple[str, Column]]) -> Column:
    pairs = [F.concat(F.lit(json.dumps(name) + ": "), text) for name, text in members]
    return F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}"))


def canonical_json(df: DataFrame, columns: Sequence[str]) -> Column:
    """A record as JSON with sorted keys at all depths, ``", "`` between and ``": "`` inside the pairs, all in ASCII."""
    return _json_object([(c, _json_value(F.col(f"`{c.replace('`', '``')}`"), df.schema[c].dataType)) for c in sorted(columns)])


def fingerprint(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.md5(canonical_json(df, columns))
