"""UUID validation (L10) and idempotent record ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings: canonical 8-4-4-4-12, braced, urn:uuid: prefixed, or 32 bare hex digits.
_HEX = "[0-9a-fA-F]"
UUID_PATTERN = (
    f"^({_HEX}{{8}}-{_HEX}{{4}}-{_HEX}{{4}}-{_HEX}{{4}}-{_HEX}{{12}}"
    f"|\\{{{_HEX}{{8}}-{_HEX}{{4}}-{_HEX}{{4}}-{_HEX}{{4}}-{_HEX}{{12}}\\}}"
    f"|[uU][rR][nN]:[uU][uU][iI][dD]:{_HEX}{{8}}-{_HEX}{{4}}-{_HEX}{{4}}-{_HEX}{{4}}-{_HEX}{{12}}"
    f"|{_HEX}{{32}})$"
)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def uuid_or_null(col) -> Column:
    """The canonical lower-case UUID when ``col`` parses as one, else NULL."""
    c = _c(col)
    bare = F.lower(F.regexp_replace(F.regexp_replace(c, "^[uU][rR][nN]:[uU][uU][iI][dD]:", ""), "[{}-]", ""))
    canon = F.concat_ws("-", F.substring(bare, 1, 8), F.substring(bare, 9, 4), F.substring(bare, 13, 4),
                        F.substring(bare, 17, 4), F.substring(bare, 21, 12))
    return F.when(c.rlike(UUID_PATTERN), canon)


def uuid_like_from(col) -> Column:
    """A deterministic UUID-shaped string from any value (md5 hex, 8-4-4-4-12)."""
    h = F.md5(_c(col).cast("string"))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def record_id(*cols) -> Column:
    """A content hash over the given columns; a retried write produces the
    same id, so ``dropDuplicates(["doc_id"])`` makes writes idempotent."""
    return F.sha2(F.to_json(F.struct(*[_c(c) for c in cols])), 256)


def map_text(col) -> Column:
    """A string map as ``k=v`` pairs sorted and joined by ``;`` (a stable,
    engine-independent rendering for reports and checks)."""
    m = _c(col)
    pairs = F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.array_sort(pairs), ";")
