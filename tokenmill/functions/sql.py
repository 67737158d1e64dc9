"""SQL access: the same functions, callable from ``spark.sql``.

Pure-expression functions are SQL UDFs (``CREATE TEMPORARY FUNCTION ...
RETURN expr``), so they compile to the same JVM expressions as the DataFrame
API.  BPE encoding needs the Arrow piece encoder, registered with
``spark.udf.register``; decoding is a SQL function over the vocabulary literal.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tokenmill.constants import EOT, GPT2_PATTERN_JAVA, WS_CHARS, WS_STRIP


def _raw(s: str) -> str:
    if '"' in s:
        raise ValueError("pattern cannot contain a double quote")
    return f'r"{s}"'


def register_sql_functions(spark: SparkSession, model=None, prefix: str = "tm_") -> list[str]:
    """Register ``{prefix}strip/normalize/fingerprint/pretokens`` and, with a
    model, ``{prefix}bpe_encode(text)`` / ``{prefix}bpe_decode(ids)``."""
    ws = WS_STRIP
    chars = "".join(f"\\u{ord(c):04x}" for c in WS_CHARS)
    strip = f"btrim(t, '{chars}')"
    normal = f"trim(regexp_replace(t, {_raw(ws + '+')}, ' '))"
    defs = {
        "strip": ("t STRING", "STRING", strip),
        "normalize": ("t STRING", "STRING", normal),
        "fingerprint": ("t STRING", "STRING", f"sha2({normal}, 256)"),
        "pretokens": ("t STRING", "ARRAY<STRING>", f"regexp_extract_all(t, {_raw(GPT2_PATTERN_JAVA)}, 0)"),
    }
    names = []
    for name, (args, ret, body) in defs.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({args}) RETURNS {ret} RETURN {body}")
        names.append(prefix + name)
    if model is not None:
        from tokenmill.operators.codec import _check_size, _quoted, make_piece_encoder

        _check_size(model)
        spark.udf.register(f"{prefix}bpe_encode_pieces", make_piece_encoder(model))
        # as encode_documents: split at the marker, strip the parts, a null text is empty
        text, marker = "coalesce(t, '')", EOT.replace("'", "\\'")
        parts = f"transform(split({text}, {_raw(_quoted(EOT))}, -1), p -> {strip.replace('(t,', '(p,')})"
        pieces = f"regexp_extract_all(s, {_raw(GPT2_PATTERN_JAVA)}, 0)"
        has = f"contains({text}, '{marker}')"
        spark.sql(
            f"""CREATE OR REPLACE TEMPORARY FUNCTION {prefix}bpe_encode(t STRING) RETURNS ARRAY<INT>
                RETURN {prefix}bpe_encode_pieces(transform(CASE WHEN {has} THEN {parts} ELSE array({text}) END, s -> {pieces}), {has})"""
        )
        top = max(model.id_bytes)
        hexes = ",".join(model.id_bytes[i].hex().upper() if i in model.id_bytes else "" for i in range(top + 1))
        spark.sql(
            f"""CREATE OR REPLACE TEMPORARY FUNCTION {prefix}bpe_decode(ids ARRAY<INT>) RETURNS STRING
                RETURN make_valid_utf8(CAST(unhex(array_join(transform(coalesce(ids, array()),
                    i -> CASE WHEN i >= 0 THEN try_element_at(split('{hexes}', ','), i + 1) END), '')) AS STRING))"""
        )
        names += [prefix + "bpe_encode", prefix + "bpe_decode"]
    return names
