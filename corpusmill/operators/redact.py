"""Redaction policy: drop metadata keys at every depth and regex-mask every
string value at every depth (PRJ15-17).

The policy is validated on the driver once; the schema of the frame is walked
once on the driver and turned into Column expressions (struct rebuilds,
``transform`` for arrays, ``map_filter``/``transform_values`` for maps), so
the per-row work is plain codegen'd ``regexp_replace``.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill import config as C
from corpusmill.functions import freeform as FF


@dataclass(frozen=True)
class Rule:
    pattern: str          # Java regex
    replacement: str      # Java replacement
    source_pattern: str   # as written (Python syntax)
    source_replacement: str = ""
    flags: tuple = ()

    def python(self) -> tuple[str, int, str]:
        """(pattern, flags, replacement) for Python's ``re``."""
        return self.source_pattern, sum(getattr(re, f) for f in set(self.flags)), self.source_replacement


@dataclass(frozen=True)
class RedactionPolicy:
    drop_keys: tuple = C.DEFAULT_DROP_KEYS
    rules: tuple = field(default_factory=tuple)


def java_pattern(pattern: str, flags=()) -> str:
    """Python regex -> Java regex with Python semantics: Unicode classes and
    case folding, only '\\n' as line end, named-group syntax, '\\Z'."""
    inline = "dU"
    for f in flags:
        if f not in C.REGEX_FLAGS:
            raise ValueError(f"Unsupported regex flag: {f}")
        inline += {"IGNORECASE": "i", "MULTILINE": "m", "DOTALL": "s"}[f]
    p = re.sub(r"\(\?P<([A-Za-z_][A-Za-z0-9_]*)>", r"(?<\1>", pattern)
    p = re.sub(r"\(\?P=([A-Za-z_][A-Za-z0-9_]*)\)", r"\\k<\1>", p)
    p = re.sub(r"(?<!\\)((?:\\\\)*)\\Z", r"\1\\z", p)
    return f"(?{inline}){p}"


def java_replacement(repl: str) -> str:
    """Python replacement template -> Java: \\1 and \\g<..> become group
    references, '$' is escaped, Python escapes are decoded."""
    out, i = [], 0
    simple = {"n": "\n", "t": "\t", "r": "\r", "f": "\f", "v": "\v", "a": "\a", "b": "\b", "\\": "\\\\"}
    while i < len(repl):
        ch = repl[i]
        if ch == "$":
            out.append("\\$")
        elif ch == "\\" and i + 1 < len(repl):
            nxt = repl[i + 1]
            if nxt.isdigit():
                j = i + 1
                while j < len(repl) and repl[j].isdigit() and j < i + 3:
                    j += 1
                out.append("$" + repl[i + 1:j])
                i = j
                continue
            if nxt == "g":
                m = re.match(r"\\g<([^>]+)>", repl[i:])
                if not m:
                    raise ValueError(f"bad group reference in replacement: {repl!r}")
                name = m.group(1)
                out.append("$" + name if name.isdigit() else "${" + name + "}")
                i += m.end()
                continue
            if nxt in simple:
                out.append(simple[nxt])
            elif nxt.isascii() and nxt.isalpha():
                raise ValueError(f"bad escape \\{nxt} in replacement: {repl!r}")
            else:  # unknown non-letter escape: backslash and character are kept
                out.append("\\\\" + ("\\$" if nxt == "$" else nxt))
            i += 2
            continue
        elif ch == "\\":
            out.append("\\\\")
        else:
            out.append(ch)
        i += 1
    return "".join(out)


def _policy_document(source) -> dict:
    """A policy given as a dict, as JSON text, or as the path of a JSON file."""
    if isinstance(source, str) and not source.lstrip().startswith("{"):
        with open(source, encoding="utf-8") as fh:
            source = fh.read()
    return json.loads(source) if isinstance(source, str) else source


def _drop_key_faults(keys):
    if not (isinstance(keys, list) and {type(k) for k in keys} <= {str}):
        yield "drop_keys: want a list of key names"
        return
    for k in sorted({*keys} & {*C.REQUIRED_SAMPLE_KEYS}):
        yield f"drop_keys: every sample needs {k!r}"


def _rule_of(spec) -> Rule:
    """One rule; raises on anything Python's ``re`` or the translation rejects."""
    match spec:
        case {"pattern": str(pattern)}:
            re.compile(pattern)
            flags, replacement = tuple(spec.get("flags", ())), str(spec.get("replacement", ""))
            return Rule(java_pattern(pattern, flags), java_replacement(replacement), pattern, replacement, flags)
    raise ValueError("want an object with a text pattern")


def load_policy(payload) -> RedactionPolicy:
    """A checked policy. All faults of the document are reported together."""
    document = _policy_document(payload)
    if not isinstance(document, dict):
        raise ValueError("redaction policy: want a JSON object")
    keys = document.get("drop_keys", [*C.DEFAULT_DROP_KEYS])
    faults, rules = [*_drop_key_faults(keys)], []
    for at, spec in enumerate(document.get("rules", ())):
        try:
            rules.append(_rule_of(spec))
        except (ValueError, re.error) as fault:
            faults.append(f"rules[{at}]: {fault}")
    if faults:
        raise ValueError("redaction policy: " + "; ".join(faults))
    return RedactionPolicy(tuple(keys), tuple(rules))


def _redact_string(c: Column, rules) -> Column:
    for r in rules:
        c = F.regexp_replace(c, r.pattern, r.replacement)
    return c


def _walk(c: Column, dtype: T.DataType, drop: frozenset, rules) -> Column:
    if isinstance(dtype, T.VariantType) or (isinstance(dtype, (T.ArrayType, T.MapType)) and FF.has_variant(dtype)):
        value = c if isinstance(dtype, T.VariantType) else F.to_variant_object(c)
        return FF.rewrite_values(value, drop, [r.python() for r in rules]) if drop or rules else value
    if isinstance(dtype, T.StringType):
        return _redact_string(c, rules) if rules else c
    if isinstance(dtype, T.StructType):
        kept = [f for f in dtype.fields if f.name not in drop]
        if not kept:  # Spark has no struct without fields; an empty map is written as {}
            return F.when(c.isNotNull(), F.create_map().cast("map<string,string>"))
        inner = F.struct(*[_walk(c[f.name], f.dataType, drop, rules).alias(f.name) for f in kept])
        return F.when(c.isNotNull(), inner)
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: _walk(x, dtype.elementType, drop, rules))
    if isinstance(dtype, T.MapType):
        m = c
        if isinstance(dtype.keyType, T.StringType) and drop:
            m = F.map_filter(m, lambda k, v: ~k.isin(*drop))
        return F.transform_values(m, lambda k, v: _walk(v, dtype.valueType, drop, rules))
    return c


def apply_policy(df: DataFrame, policy: RedactionPolicy | None = None, drop_keys=None, keep=()) -> DataFrame:
    """Drop ``drop_keys`` at every depth and apply the rules, in order, to
    every string value at every depth. Columns in ``keep`` pass unchanged."""
    drop = frozenset(drop_keys if drop_keys is not None else (policy.drop_keys if policy else ()))
    rules = policy.rules if policy else ()
    cols = []
    for f in df.schema.fields:
        if f.name in keep:
            cols.append(F.col(f.name))
        elif f.name not in drop:
            cols.append(_walk(F.col(f.name), f.dataType, drop, rules).alias(f.name))
    return df.select(*cols)


def drop_metadata(df: DataFrame, drop_keys=C.DEFAULT_DROP_KEYS, keep=()) -> DataFrame:
    return apply_policy(df, None, drop_keys, keep)
