"""Reversible encryption of personal columns with Spark's own AES (JVM side, no Python workers)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _key(key: bytes | Column) -> Column:
    return key if isinstance(key, Column) else F.lit(bytearray(key))


def encrypt_text(c: Column | str, key: bytes | Column) -> Column:
    text = F.col(c) if isinstance(c, str) else c
    cipher = F.base64(F.aes_encrypt(F.encode(text, "UTF-8"), _key(key)))
    return F.when(F.length(text) > 0, cipher)


def decrypt_text(c: Column | str, key: bytes | Column) -> Column:
    text = F.col(c) if isinstance(c, str) else c
    plain = F.decode(F.aes_decrypt(F.unbase64(text), _key(key)), "UTF-8")
    return F.when(F.length(text) > 0, plain)


def encrypt_columns(df: DataFrame, columns: Sequence[str], key: bytes | Column) -> DataFrame:
    """Replace each column by its cipher text; null and empty become null.

    ``key`` has 16, 24 or 32 bytes. It becomes part of the plan: read it from a
    secret store and do not print plans that hold it.
    """
    return df.withColumns({c: encrypt_text(f"`{c}`", key) for c in columns})


def decrypt_columns(df: DataFrame, columns: Sequence[str], key: bytes | Column) -> DataFrame:
    return df.withColumns({c: decrypt_text(f"`{c}`", key) for c in columns})
