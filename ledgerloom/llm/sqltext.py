"""Pieces of DuckDB SQL that several queries' oracles use."""

from __future__ import annotations

#: CTEs (after WITH RECURSIVE) with ``crc_table``: one row, the 256 steps of crc32 that eight shifts of each byte give.
CRC_TABLE_SQL = """crc_bits AS (
  SELECT i, 0 AS k, i::BIGINT AS c FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_bits WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY i) AS steps FROM crc_bits WHERE k = 8)"""


def crc32_sql(text: str) -> str:
    """Unsigned crc32 of a text's UTF-8 bytes, byte by byte; ``crc_table`` must be in FROM."""
    bytes_ = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_}), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295)::BIGINT"
