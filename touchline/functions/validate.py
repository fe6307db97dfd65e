"""Contract validation as generated column expressions.

A payload whose leaves all have the JSON types of its contract is parsed once,
with a strict schema, and is done if it lacks nothing.  Any other is parsed with
a shadow schema whose leaves are all strings; typed values and a list of errors
are generated from it, as SQL text, so lax coercions and their failures are
seen.  Nothing here leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .contracts import INCIDENT_NULLABLE, INCIDENT_REQUIRED, Contract
from .scalars import fraction, let, once

ERROR = "struct<path:string,code:string,value:string>"
TYPES = {"str": "string", "int": "bigint", "float": "double", "bool": "boolean", "map": "map<string,double>", "raw": "string", "fraction": "struct<num:int,den:int>"}


def _split(name: str) -> tuple[str, bool, bool]:
    """The key in the document, whether it is required, and whether it may be null."""
    key = name.partition("=")[0]
    return key.rstrip("!?"), "!" in key, key.endswith("?") or "!" not in key


def _called(name: str) -> str:
    """What a field is called once it is parsed."""
    return name.partition("=")[2] or _split(name)[0]


def shadow(kind: Any) -> str:
    """The schema that a payload is parsed with."""
    if isinstance(kind, tuple):
        kind = kind[0]
    if isinstance(kind, list):
        return f"array<{shadow(kind[0])}>"
    if isinstance(kind, dict):
        return "struct<" + ",".join(f"`{_split(k)[0]}`:{shadow(v)}" for k, v in kind.items()) + ">"
    return "map<string,double>" if kind == "map" else "string"


def typed(kind: Any) -> str:
    """The schema of the parsed value."""
    if isinstance(kind, tuple):
        kind = kind[0]
    if isinstance(kind, list):
        return f"array<{typed(kind[0])}>"
    if isinstance(kind, dict):
        return "struct<" + ",".join(f"`{_called(k)}`:{typed(v)}" for k, v in kind.items()) + ">"
    return TYPES[kind]


def strict(kind: Any) -> str:
    """The schema that a payload is parsed with first: leaves have their own JSON type."""
    if isinstance(kind, tuple):
        kind = kind[0]
    if isinstance(kind, list):
        return f"array<{strict(kind[0])}>"
    if isinstance(kind, dict):
        return "struct<" + ",".join(f"`{_split(k)[0]}`:{strict(v)}" for k, v in kind.items()) + ">"
    return TYPES[kind]


def coerce(text: str, kind: str) -> str:
    """Lax coercion of a JSON leaf held as text; null where it fails.  Whole
    numbers in their usual form, the most common leaves, need no pattern."""
    t = f"trim({text})"
    if kind == "int":
        plain = f"try_cast({text} AS bigint)"
        return f"CASE WHEN cast({plain} AS string) = {text} THEN {plain} WHEN {t} = 'true' THEN 1L WHEN {t} = 'false' THEN 0L WHEN {t} RLIKE '^[+-]?[0-9]+([.]0*)?$' THEN try_cast(regexp_extract({t}, '^([+-]?[0-9]+)', 1) AS bigint) END"
    if kind == "float":
        return f"CASE WHEN {t} = 'true' THEN 1D WHEN {t} = 'false' THEN 0D ELSE try_cast({t} AS double) END"
    if kind == "bool":
        return f"CASE WHEN lower({t}) IN ('true', '1', '1.0', 't', 'y', 'yes', 'on') THEN true WHEN lower({t}) IN ('false', '0', '0.0', 'f', 'n', 'no', 'off') THEN false END"
    return fraction(text) if kind == "fraction" else text


NO_ERRORS = f"cast(array() AS array<{ERROR}>)"


def _fault(path: str, code: str, value: str = "NULL") -> str:
    return f"named_struct('path', '{path}', 'code', '{code}', 'value', cast({value} AS string))"


def _gather(ones: list[str], many: list[str]) -> str:
    """One array of errors from single ones (null: none) and arrays of them."""
    parts = ([f"array_compact(array({', '.join(ones)}))"] if ones else []) + [f"coalesce({m}, {NO_ERRORS})" for m in many]
    return f"concat({', '.join(parts)})" if len(parts) > 1 else parts[0] if parts else NO_ERRORS


def _member(parent: str, key: str) -> str:
    return f"{parent}.`{key}`"


def _default(value: object) -> str:
    return str(value).lower() if isinstance(value, bool) else f"{value}L"


def typed_value(value: str, kind: Any, depth: int = 0) -> str:
    if isinstance(kind, tuple):
        default = f"cast(array() AS {typed(kind)})" if isinstance(kind[0], list) else _default(kind[1])
        return f"CASE WHEN {value} IS NULL THEN {default} ELSE {typed_value(value, kind[0], depth)} END"
    if isinstance(kind, list):
        return value if kind[0] in ("str", "raw") else f"transform({value}, x{depth} -> {typed_value(f'x{depth}', kind[0], depth + 1)})"
    if isinstance(kind, dict):
        members = ", ".join(f"'{_called(k)}', {typed_value(_member(value, _split(k)[0]), v, depth)}" for k, v in kind.items())
        return f"CASE WHEN {value} IS NOT NULL THEN named_struct({members}) END"
    return value if kind in ("str", "raw", "map") else coerce(value, kind)


def strict_value(value: str, kind: Any, depth: int = 0, only: tuple[str, ...] | None = None, path: str = "") -> str:
    """The typed value of what the strict schema gave: only defaults and names
    differ.  With ``only`` members outside of these dotted paths are null."""
    if only is not None and path in only:
        only = None
    if isinstance(kind, tuple):
        default = f"cast(array() AS {typed(kind)})" if isinstance(kind[0], list) else _default(kind[1])
        return f"coalesce({strict_value(value, kind[0], depth, only, path)}, {default})"
    if isinstance(kind, list):
        inner = strict_value(f"x{depth}", kind[0], depth + 1, only, path)
        return value if inner == f"x{depth}" else f"transform({value}, x{depth} -> {inner})"
    if isinstance(kind, dict):
        members = {}
        for k, v in kind.items():
            members[k] = _asked(_member(value, _split(k)[0]), v, depth, only, f"{path}.{_called(k)}".lstrip("."))
        if all(m == _member(value, _called(k)) for k, m in members.items()):
            return value
        made = ", ".join(f"'{_called(k)}', {m}" for k, m in members.items())
        return f"CASE WHEN {value} IS NOT NULL THEN named_struct({made}) END"
    return value


def _asked(value: str, kind: Any, depth: int, only: tuple[str, ...] | None, path: str) -> str:
    if only is None or any(path == o or o.startswith(f"{path}.") for o in only):
        return strict_value(value, kind, depth, only, path)
    return f"cast(NULL AS {typed(kind)})"


def lacking(value: str, kind: Any, required: bool, parent: str | None, depth: int = 0) -> list[str]:
    """Conditions under which what the strict schema gave breaks the contract."""
    if isinstance(kind, tuple):
        kind = kind[0]
    out = []
    if required:
        out.append(f"{value} IS NULL" if parent is None else f"{value} IS NULL AND {parent} IS NOT NULL")
    if isinstance(kind, list):
        inner = lacking(f"x{depth}", kind[0], True, None, depth + 1) if isinstance(kind[0], dict) else []
        if inner:
            out.append(f"exists({value}, x{depth} -> {' OR '.join(inner)})")
    elif isinstance(kind, dict):
        for name, sub in kind.items():
            key, need, may_null = _split(name)
            out += lacking(_member(value, key), sub, need and not may_null, value, depth)
    return out


def faults(value: str, made: str, kind: Any, path: str, required: bool, nullable: bool, parent: str | None, depth: int = 0) -> tuple[list[str], list[str]]:
    """Errors of a value and what was ``made`` of it: single ones, and arrays of
    those inside arrays.  A leaf that is there but could not be made is wrong.
    What is required is only missed where ``parent`` is there."""
    if isinstance(kind, tuple):
        kind = kind[0]
    ones, many = [], []
    if required and not nullable:
        there = "" if parent is None else f" AND {parent} IS NOT NULL"
        ones.append(f"CASE WHEN {value} IS NULL{there} THEN {_fault(path, 'missing')} END")
    if isinstance(kind, list):
        if isinstance(kind[0], dict):
            inner = _gather(*faults(f"x{depth}", f"t{depth}", kind[0], path + "[]", True, False, None, depth + 1))
            many.append(f"flatten(zip_with({value}, {made}, (x{depth}, t{depth}) -> {inner}))")
    elif isinstance(kind, dict):
        for name, sub in kind.items():
            key, need, may_null = _split(name)
            more = faults(_member(value, key), _member(made, _called(name)), sub, f"{path}.{key}".lstrip("."), need, may_null, value, depth)
            ones += more[0]
            many += more[1]
    elif kind not in ("str", "raw", "map"):
        ones.append(f"CASE WHEN {value} IS NOT NULL AND {made} IS NULL THEN {_fault(path, kind, value)} END")
    return ones, many


def faulty(value: str, made: str, kind: Any, required: bool, parent: str | None, depth: int = 0) -> list[str]:
    """Conditions under which ``faults`` gives any: they cost no arrays of errors, which few documents have."""
    if isinstance(kind, tuple):
        kind = kind[0]
    out = []
    if required:
        out.append(f"{value} IS NULL" if parent is None else f"{value} IS NULL AND {parent} IS NOT NULL")
    if isinstance(kind, list):
        if isinstance(kind[0], dict):
            inner = " OR ".join(f"({c})" for c in faulty(f"x{depth}", f"t{depth}", kind[0], True, None, depth + 1))
            out.append(f"coalesce(array_contains(zip_with({value}, {made}, (x{depth}, t{depth}) -> {inner}), true), false)")
    elif isinstance(kind, dict):
        for name, sub in kind.items():
            key, need, may_null = _split(name)
            out += faulty(_member(value, key), _member(made, _called(name)), sub, need and not may_null, value, depth)
    elif kind not in ("str", "raw", "map"):
        out.append(f"{value} IS NOT NULL AND {made} IS NULL")
    return out


def incident_errors(incidents: str) -> str:
    """Required fields by type; an unknown type makes the payload invalid."""
    kind = "x.incidentType"
    known = ", ".join(f"'{k}'" for k in INCIDENT_REQUIRED)
    ones = [f"CASE WHEN {kind} NOT IN ({known}) THEN {_fault('incidents[].incidentType', 'unknown_type', kind)} END"]
    need: dict[str, list[str]] = {}
    for name, fields in INCIDENT_REQUIRED.items():
        for f in fields:
            if f not in INCIDENT_NULLABLE.get(name, ()):
                need.setdefault(f, []).append(f"'{name}'")
    ones += [f"CASE WHEN {kind} IN ({', '.join(names)}) AND x.`{f}` IS NULL THEN {_fault(f'incidents[].{f}', 'missing', kind)} END" for f, names in need.items()]
    return f"flatten(transform({incidents}, x -> {_gather(ones, [])}))"


@dataclass(frozen=True)
class Compiled:
    """A contract as SQL text over columns _shadow and parsed: Spark's parser
    builds the expressions in one call, not one call for each node of them."""

    shadow: str
    #: Of a parsed document, put in for {}: its typed value, errors and error code.  Lambdas
    #: name the two stages, so that each is worked out once and stays out of compiled code.
    checked: str
    #: None where leaves are no JSON types of their own (fractions): then all go the second way.
    strict: str | None
    #: Of _strict, what the strict schema gave: the typed value, null where it isn't sure to be valid.
    sound: str


_COMPILED: dict[str, Compiled] = {}
#: Holds the text of a document that doesn't meet the strict schema.
CORRUPT = "_corrupt_text"


def compiled(contract: Contract, only: tuple[str, ...] | None = None) -> Compiled:
    """The text of a contract, made once a process."""
    key = repr(contract) + (f" of {only}" if only else "")
    if key not in _COMPILED:
        ones, many = faults("_shadow", "parsed", contract.fields, "", False, True, None)
        wrong = ["_strict IS NULL", f"_strict.{CORRUPT} IS NOT NULL", *lacking("_strict", contract.fields, False, None)]
        if contract.name == "incidents":
            many.append(incident_errors("_shadow.incidents"))
            wrong.append(f"size({incident_errors('_strict.incidents')}) > 0")
        enveloped = contract.fields | {"error": {"code": "str"}}
        made = ", ".join(f"'{_called(k)}', {_asked(_member('_strict', _split(k)[0]), v, 0, only, _called(k))}" for k, v in contract.fields.items())
        sound = f"CASE WHEN coalesce({' OR '.join(f'({w})' for w in wrong)}, false) THEN NULL ELSE named_struct({made}) END"
        errors = _gather(ones, many)
        if contract.name != "incidents":  # whose own rules are no part of the test
            errors = f"CASE WHEN {' OR '.join(f'({c})' for c in faulty('_shadow', 'parsed', contract.fields, False, None))} THEN {errors} ELSE {NO_ERRORS} END"
        value, errors = (x.replace("{", "{{").replace("}", "}}") for x in (typed_value("_shadow", contract.fields), errors))
        checked = f"transform(array({{}}), _shadow -> transform(array({value}), parsed -> named_struct('parsed', parsed, 'errors', {errors}, 'code', try_cast(_shadow.error.code AS int)))[0])[0]"
        _COMPILED[key] = Compiled(shadow(enveloped), checked, None if "'fraction'" in key else strict(enveloped | {CORRUPT: "str"}), sound)
    return _COMPILED[key]


def telling(kind: Any, shape: tuple[str, ...], path: str = "") -> Any:
    """A contract without what no verdict depends on: optional texts, as any leaf
    can be read as one, but for those named in ``shape``.  An object stays one."""
    if isinstance(kind, tuple):
        return (telling(kind[0], shape, path), *kind[1:])
    if isinstance(kind, list):
        return [telling(kind[0], shape, path)]
    if not isinstance(kind, dict):
        return kind
    at = {k: f"{path}.{_called(k)}".lstrip(".") for k in kind}
    kept = {k: telling(v, shape, at[k]) for k, v in kind.items() if v not in ("str", "raw") or _split(k)[1] or at[k] in shape}
    return kept or dict(list(kind.items())[:1])


def outline(value: str, kind: Any, shape: tuple[str, ...], path: str = "", depth: int = 0) -> str:
    """Of what the strict schema gave only the members of ``shape``, an object that is there and an
    array's elements as true: what leaves a lambda is copied, so it is kept small."""
    if isinstance(kind, tuple):
        default = "array()" if isinstance(kind[0], list) else _default(kind[1])
        return f"coalesce({outline(value, kind[0], shape, path, depth)}, {default})"
    if isinstance(kind, list):
        return f"transform({value}, x{depth} -> {'true' if path in shape else outline(f'x{depth}', kind[0], shape, path, depth + 1)})"
    if not isinstance(kind, dict):
        return value
    if path in shape:
        return f"CASE WHEN {value} IS NOT NULL THEN true END"
    at = {k: f"{path}.{_called(k)}".lstrip(".") for k in kind}
    made = ", ".join(f"'{_called(k)}', {outline(_member(value, _split(k)[0]), v, shape, at[k], depth)}" for k, v in kind.items() if any(f"{o}.".startswith(f"{at[k]}.") for o in shape))
    return f"CASE WHEN {value} IS NOT NULL THEN named_struct({made}) END"


_TELLTALE: dict[str, str] = {}


def telltale(contract: Contract, payload: str, shape: tuple[str, ...] | None) -> str:
    """SQL text of struct<sound,parsed> of a column: sound is true where the strict schema
    shows that the payload is valid, parsed has the members of ``shape`` alone, all if it is None."""
    key = f"{contract!r} of {payload} and {shape}"
    if key not in _TELLTALE:
        own = tuple(f"incidents.{f}" for need in INCIDENT_REQUIRED.values() for f in need) if contract.name == "incidents" else ()
        fields = contract.fields if shape is None else telling(contract.fields, shape + own)
        wrong = ["_strict IS NULL", f"_strict.{CORRUPT} IS NOT NULL", "_strict.error IS NOT NULL", *lacking("_strict", fields, False, None)]
        if contract.name == "incidents":
            wrong.append(f"size({incident_errors('_strict.incidents')}) > 0")
        made = strict_value("_strict", fields) if shape is None else outline("_strict", fields, shape)
        read = f"from_json(`{payload}`, '{strict(fields | {'error': {'code': 'str'}, CORRUPT: 'str'})}', map('columnNameOfCorruptRecord', '{CORRUPT}'))"
        _TELLTALE[key] = f"transform(array({read}), _strict -> named_struct('sound', NOT coalesce({' OR '.join(f'({w})' for w in wrong)}, false), 'parsed', {made}))[0]"
    return _TELLTALE[key]


def explicit_nulls(payload: Column, where: str, names: tuple[str, ...]) -> Column:
    """Errors for keys that are present with a null where only absence may stand."""
    first, _, rest = where.partition(".")
    bad = lambda keys, n: F.coalesce(F.map_contains_key(keys, n) & keys[n].isNull(), F.lit(False))
    errors = lambda hit: F.array_compact(F.array(*(F.when(hit(n), F.expr(_fault(f"{where}.{n}", "null"))) for n in names)))
    if not first.endswith("[]"):
        keys = F.from_json(F.get_json_object(payload, f"$.{where}"), "map<string,string>")
        return let(keys, lambda m: errors(lambda n: bad(m, n)))
    elements = F.from_json(F.get_json_object(payload, f"$.{first[:-2]}"), "array<string>")
    maps = F.transform(elements, lambda x: F.from_json(F.get_json_object(x, f"$.{rest}") if rest else x, "map<string,string>"))
    return let(maps, lambda all_: errors(lambda n: F.coalesce(F.exists(all_, lambda m: bad(m, n)), F.lit(False))))


def is_empty(payload: Column) -> Column:
    """No document: null, blank, ``{}``, or JSON that is no object."""
    return payload.isNull() | ~payload.rlike(r"(?s)^\s*\{") | payload.rlike(r"(?s)^\s*\{\s*\}\s*$")


def envelope_code(payload: Column) -> Column:
    """Code of an error envelope, null where there is none."""
    return F.get_json_object(payload, "$.error.code").try_cast("int")


def validate_payload(df: DataFrame, contract: Contract, payload: str = "payload", parity: bool = False, shaped: Callable[[Column], dict[str, Column]] | None = None, only: tuple[str, ...] | None = None) -> DataFrame:
    """``df`` with parsed, errors, is_valid and reason.

    ``shaped`` may change the document between parsing and checking: of the
    parsed document, all leaves text, it makes the new _shadow and further columns.
    ``only`` names the members (dotted paths, arrays without an index) that the
    caller will read: all are checked, others may be null in ``parsed``.

    reason: empty, http_<code>, invalid_contract, or null for a valid payload.
    With ``parity`` the error envelope is not looked for, except in odds.
    """
    text, made = F.col(payload), compiled(contract, only)
    nulls = text.contains("null") if contract.no_nulls else F.lit(False)  # most payloads have none
    fresh = f"from_json(`{payload}`, '{made.shadow}')"
    if shaped:
        out = df.withColumn("_shadow", F.expr(fresh))
        more = shaped(F.col("_shadow"))
        out = once(out, _shadow=more.pop("_shadow")).withColumns(more)
        out = out.withColumn("_found", F.expr(made.checked.format("_shadow"))).drop("_shadow")
    elif made.strict is None:
        out = df.withColumn("_found", F.expr(made.checked.format(fresh)))
    else:
        # a document with a first key is not empty; one with an envelope goes the other way
        plain = text.startswith('{"') & F.col("_strict.error").isNull() & ~nulls
        out = once(df, _strict=F.from_json(text, made.strict, {"columnNameOfCorruptRecord": CORRUPT}))
        out = out.withColumn("_sound", F.when(plain, F.expr(made.sound))).drop("_strict")
        out = out.withColumn("_found", F.when(F.col("_sound").isNull(), F.expr(made.checked.format(fresh))))
    errors = [F.coalesce("_found.errors", F.expr(NO_ERRORS))]
    for where, names in contract.no_nulls:
        errors.append(F.coalesce(F.when(nulls, explicit_nulls(text, where, names)), F.expr(NO_ERRORS)))
    out = out.withColumn("_errors", F.concat(*errors) if len(errors) > 1 else errors[0])
    sound = F.col("_sound").isNotNull() if "_sound" in out.columns else F.lit(False)
    code = F.col("_found.code") if not parity or contract.name == "odds" else F.lit(None).cast("int")
    reason = F.when(sound, None).when(is_empty(text), "empty").when(code.isNotNull(), F.concat(F.lit("http_"), code.cast("string"))).when(F.size("_errors") > 0, "invalid_contract")
    parsed = F.coalesce("_sound", "_found.parsed") if "_sound" in out.columns else F.col("_found.parsed")
    out = once(out, parsed=parsed, errors=F.col("_errors"), reason=reason).drop("_sound", "_found", "_errors")
    return out.withColumn("is_valid", F.col("reason").isNull())


def holding(contract: Contract, holds: Callable[[Column], Column], payload: str = "payload", shape: tuple[str, ...] | None = None) -> Column:
    """Whether a payload is valid, as ``validate_payload`` says, and ``holds`` is true of the parsed document.

    No list of errors is made for most, and the document doesn't leave the expression.  With ``shape``
    ``holds`` looks only at these members (dotted paths), and there at null or not and at the size of arrays.
    """
    text, made = F.col(payload), compiled(contract)
    met = lambda doc: F.coalesce(holds(doc), F.lit(False))
    nulls = text.rlike("null") if contract.no_nulls else F.lit(False)  # a search by pattern skips, contains doesn't
    found = F.expr(made.checked.format(f"from_json(`{payload}`, '{made.shadow}')"))
    slow = let(found, lambda f: f["code"].isNull() & (F.size(f["errors"]) == 0) & met(f["parsed"]))
    for where, names in contract.no_nulls:
        slow = slow & F.coalesce(F.when(nulls, F.size(explicit_nulls(text, where, names)) == 0), F.lit(True))
    slow = F.when(is_empty(text), False).otherwise(slow)
    if made.strict is None:
        return slow
    sure = let(F.expr(telltale(contract, payload, shape)), lambda x: F.when(x["sound"], met(x["parsed"])))
    return let(F.when(text.startswith('{"') & ~nulls, sure), lambda known: F.when(known.isNotNull(), known).otherwise(slow))


def enveloped(payload: Column) -> Column:
    """Whether ``envelope_code`` finds a code: only texts that may name an envelope, escaped or not, are parsed for it."""
    return F.when(payload.rlike('"error"') | payload.rlike(r"\\u00"), envelope_code(payload).isNotNull()).otherwise(False)


def normalise_status(event: Column) -> Column:
    """An event whose match isn't played: empty time and scores become null."""
    waiting = F.lower(event["status"]["type"]).isin("postponed", "cancelled", "notstarted")
    blank = lambda x: F.when(waiting & x.isNotNull() & F.to_json(x).isin("{}", '{"injuryTime1":0,"injuryTime2":0}'), None).otherwise(x)
    return event.withField("time", blank(event["time"])).withField("homeScore", blank(event["homeScore"])).withField("awayScore", blank(event["awayScore"]))


def quarantine(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and invalid ones with their reason and error paths."""
    return validated.where("is_valid").drop("errors", "reason", "is_valid"), validated.where("not is_valid").drop("parsed", "is_valid")
