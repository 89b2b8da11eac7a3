"""Pieces of DuckDB SQL that several operators' queries share."""


def crc32(text: str) -> str:
    """Unsigned crc32 of a text expression's ASCII characters; null for null."""
    bit = "CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END"
    byte = f"list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, i: {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    found = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {byte}), 4294967295)"
    return f"CASE WHEN {text} IS NOT NULL THEN {found} END"
