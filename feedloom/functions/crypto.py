"""HMAC-SHA256 as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 64
_ALL_BYTES = "".join(map(chr, range(256)))
_ZERO_MARK = "Ā"  # translate() drops a target of U+0000, so zero goes through a stand-in


def _xor_bytes(c: Column, mask: int) -> Column:
    """Every byte of a binary column xor ``mask``."""
    target = "".join(chr(b ^ mask) if b != mask else _ZERO_MARK for b in range(256))
    text = F.translate(F.decode(c, "ISO-8859-1"), _ALL_BYTES, target)
    return F.encode(F.replace(text, F.lit(_ZERO_MARK), F.lit("\u0000")), "ISO-8859-1")


def hmac_pads(secret: Column) -> Column:
    """Inner and outer key block of a secret; depends on the key alone, so compute it per key."""
    raw = F.encode(secret, "UTF-8")
    key = F.when(F.length(raw) > _BLOCK, F.unhex(F.sha2(raw, 256))).otherwise(raw)
    block = F.rpad(key, _BLOCK, F.unhex(F.lit("00")))
    return F.struct(_xor_bytes(block, 0x36).alias("inner"), _xor_bytes(block, 0x5C).alias("outer"))


def hmac_sha256_hex(pads: Column, message: Column) -> Column:
    """Lower-case hex HMAC-SHA256 of ``message`` under pads made by :func:`hmac_pads`."""
    inner = F.unhex(F.sha2(F.concat(pads["inner"], F.encode(message, "UTF-8")), 256))
    return F.sha2(F.concat(pads["outer"], inner), 256)
