"""SQL texts for digests that DuckDB has no function for."""

from __future__ import annotations

import hashlib

# The domains of two enumerated columns.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")

# CRC-32 polynomial (reflected), and the constants of 32-bit Murmur3.
CRC_POLYNOMIAL = 0xEDB88320
MURMUR_C1, MURMUR_C2, MURMUR_ADD = 0xCC9E2D51, 0x1B873593, 0xE6546B64
MURMUR_F1, MURMUR_F2 = 0x85EBCA6B, 0xC2B2AE35
MASK = 0xFFFFFFFF
HEX_DIGITS = "0123456789ABCDEF"


def sha512_of(column: str, domain: tuple[str, ...]) -> str:
    """SHA-512 of a column with few values, each computed by hashlib."""
    cases = " ".join(f"WHEN '{v}' THEN '{hashlib.sha512(v.encode()).hexdigest()}'" for v in domain)
    return f"CASE {column} {cases} END"


def _byte(hexed: str, position: str) -> str:
    digit = "(strpos('" + HEX_DIGITS + "', substr({h}, {p}, 1)) - 1)"
    high = digit.format(h=hexed, p=position)
    low = digit.format(h=hexed, p=f"{position} + 1")
    return f"({high} * 16 + {low})"


def crc32_of(column: str) -> str:
    """CRC-32 of the UTF-8 bytes of a text column, bit by bit."""
    hexed = f"hex(encode({column}))"
    octets = f"list_transform(range(1, length({hexed}), 2), lambda p: {_byte(hexed, 'p')}::BIGINT)"
    shift = f"CASE WHEN x & 1 = 1 THEN xor(x >> 1, {CRC_POLYNOMIAL}) ELSE x >> 1 END"
    step = f"list_reduce(range(8), lambda x, i: {shift}, xor(c, b))"
    return f"xor(list_reduce({octets}, lambda c, b: {step}, {MASK}::BIGINT), {MASK})"


def _times(value: str, factor: int) -> str:
    return f"(({value})::UBIGINT * {factor}::UBIGINT) & {MASK}::UBIGINT"


def _rotate(value: str, bits: int) -> str:
    return f"((({value}) * {1 << bits}::UBIGINT) & {MASK}::UBIGINT) | (({value}) >> {32 - bits})"


def _murmur_words(words: str, length: str) -> str:
    """Murmur3 (seed 42) of a list of 32-bit words, as a signed int."""
    mixed = _times(_rotate("m", 15), MURMUR_C2)
    mixed_word = f"list_transform([{_times('k', MURMUR_C1)}], lambda m: {mixed})[1]"
    turned = f"list_transform([xor(h, {mixed_word})], lambda t: {_rotate('t', 13)})[1]"
    step = f"(({turned}) * 5::UBIGINT + {MURMUR_ADD}::UBIGINT) & {MASK}::UBIGINT"
    body = f"list_reduce({words}, lambda h, k: {step}, 42::UBIGINT)"
    final = f"[xor({body}, ({length})::UBIGINT)]"
    for bits, factor in ((16, MURMUR_F1), (13, MURMUR_F2), (16, 1)):
        final = f"list_transform({final}, lambda z: {_times(f'xor(z, z >> {bits})', factor)})"
    unsigned = f"{final}[1]::BIGINT"
    return f"(CASE WHEN {unsigned} >= 2147483648 THEN {unsigned} - 4294967296 ELSE {unsigned} END)::INTEGER"


def murmur3_of_text(column: str) -> str:
    """Spark's murmur3 of a text column: whole words little-endian, then single signed bytes."""
    hexed = f"hex(encode({column}))"
    octets = f"octet_length(encode({column}))"
    parts = " + ".join(f"{_byte(hexed, f'(8 * w + {2 * i + 1})')}::UBIGINT * {1 << (8 * i)}::UBIGINT" for i in range(4))
    words = f"list_transform(range({octets} // 4), lambda w: {parts})"
    byte = _byte(hexed, "(2 * t + 1)")
    extended = f"CASE WHEN {byte} >= 128 THEN {byte}::UBIGINT + {MASK - 255}::UBIGINT ELSE {byte}::UBIGINT END"
    tail = f"list_transform(range({octets} // 4 * 4, {octets}), lambda t: {extended})"
    return _murmur_words(f"list_concat({words}, {tail})", octets)


def murmur3_of_bigint(column: str) -> str:
    """Spark's murmur3 of a non-negative bigint column."""
    words = f"[({column} & {MASK})::UBIGINT, ({column} >> 32)::UBIGINT]"
    return _murmur_words(words, "8")
