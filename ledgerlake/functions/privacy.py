"""Pseudonymisation and masking with built-in hash and regex expressions."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT_VARIABLE = "LEDGERLAKE_SALT"


def resolve_salt(salt: str | None = None) -> str:
    """The given salt or the environment's; hashing without one is refused."""
    salt = salt if salt is not None else os.environ.get(SALT_VARIABLE)
    if not salt:
        raise ValueError(f"no salt: pass salt= or set {SALT_VARIABLE}")
    return salt


def salted_sha256(c, salt: str | None = None) -> Column:
    """64 lower-case hex characters of sha256(value followed by salt)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sha2(F.concat(c.cast("string"), F.lit(resolve_salt(salt))), 256)


def pseudonymize(df: DataFrame, cols: Sequence[str], salt: str | None = None) -> DataFrame:
    return df.withColumns({c: salted_sha256(c, salt) for c in cols})


def mask_name(c) -> Column:
    """First letter, then one asterisk per remaining letter."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.substring(c, 1, 1), F.repeat(F.lit("*"), F.greatest(F.length(c) - 1, F.lit(0))))


def mask_cpf(c) -> Column:
    """Tax number ddd.ddd.ddd-dd keeps its six middle digits."""
    c = F.col(c) if isinstance(c, str) else c
    digits = F.regexp_replace(c, r"\D", "")
    return F.concat(
        F.lit("***."), F.substring(digits, 4, 3), F.lit("."), F.substring(digits, 7, 3), F.lit("-**")
    )


def mask_email(c) -> Column:
    """Two leading characters, three asterisks, then the domain."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.substring(F.substring_index(c, "@", 1), 1, 2), F.lit("***@"), F.substring_index(c, "@", -1))


_MASKS = {"name": mask_name, "cpf": mask_cpf, "email": mask_email}


def mask(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """``rules`` maps a column to the mask kind: name, cpf or email."""
    return df.withColumns({c: _MASKS[kind](c) for c, kind in rules.items()})
