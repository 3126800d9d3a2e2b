"""Decryption of protected columns inside the executors."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _part(keyring: DataFrame, name: str) -> Column:
    return keyring.agg(F.max(name)).scalar()


def decrypt_columns(
    df: DataFrame,
    columns: Iterable[str],
    keyring: DataFrame,
    clear_when: Column | None = None,
    strict: bool = False,
) -> DataFrame:
    """Replace base64 AES-CBC texts by their clear text.

    ``keyring`` is a one-row frame with binary columns ``key`` and ``iv`` that the caller loads from
    a secret store. It enters as a scalar subquery, so the key shows neither in plan nor in UI.
    Null, blank and already clear values (an ``@`` in them, or ``clear_when``) pass unchanged. So does
    a text that does not open; with ``strict`` it fails the job. A filter on an opened column opens the
    text at each mention, as Spark copies the expression into it: see ``with_value``.
    """
    key, iv = _part(keyring, "key"), _part(keyring, "iv")
    out = {}
    for name in columns:
        col = F.col(name)
        # A null text stays null by itself, so the column is named as seldom as can be.
        clear = col.rlike(r"\A\z|@")
        if clear_when is not None:
            clear = clear | F.coalesce(clear_when, F.lit(False))
        if strict:
            opened = F.aes_decrypt(F.concat(iv, F.unbase64(col)), key, F.lit("CBC"), F.lit("PKCS")).cast("string")
        else:
            sealed = F.concat(iv, F.try_to_binary(col, F.lit("base64")))
            opened = F.try_aes_decrypt(sealed, key, F.lit("CBC"), F.lit("PKCS"))
            # A wrong text can open to bytes that are no text.
            opened = F.coalesce(F.try_validate_utf8(opened.cast("string")), col)
        out[name] = F.when(clear, col).otherwise(opened)
    return df.withColumns(out)


def encrypt_text(col: Column, keyring: DataFrame) -> Column:
    """Base64 AES-CBC text without its vector: the stored form that ``decrypt_columns`` reads."""
    key, iv = _part(keyring, "key"), _part(keyring, "iv")
    sealed = F.aes_encrypt(col, key, F.lit("CBC"), F.lit("PKCS"), iv)
    return F.base64(F.substring(sealed, 17, 2147483647))
