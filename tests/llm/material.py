"""Texts for the tests of this folder."""

from __future__ import annotations

import duckdb

#: Texts that every operator must bear.
ODD = [
    None, "", " \t\r\n", "one", "one two", "one two three", "a b c\na b c\na b c", "Ünï çödé 中文 😀 <|endoftext|> x", "x" * 5000,
    "word " * 30000, "A\x1cB\x85C\xa0D́ E̸ H̱.", "don't WE'LL it's, <|StartOfText|> (x) é! ½ ٣", "\n\n\n",
]


def documents(sf_dir: str) -> list[tuple[int, str]]:
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet' ORDER BY doc_id").fetchall()


def texts_at(sf_dir: str) -> list[str]:
    return [t for _, t in documents(sf_dir)]
