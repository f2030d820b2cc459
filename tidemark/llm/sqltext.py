"""Pieces of checking SQL that several operators share."""

from __future__ import annotations


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text in SQL; DuckDB has no such function."""
    bits = "list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    # A byte changes the lowest eight bits; the eight steps shift the others in.
    data = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {data}), lambda crc, byte: {bits}), 4294967295)"
