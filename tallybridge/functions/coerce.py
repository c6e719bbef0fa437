"""Text of a JSON leaf -> typed value, with the type default where nothing usable is there.

No column of the model is nullable: an absent or unusable field takes the default
of its type, so a missing account number is 0 and still counts as a real account.
Each function returns ``(value, exact)``; ``exact`` is false when the value was
defaulted or altered on the way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import ZERO_UUID

# Fixed pattern: canonical 8-4-4-4-12 form.
UUID_PATTERN = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def whole_number(text: Column, kind: str) -> tuple[Column, Column]:
    """``420``, ``"420"`` and ``5.0`` are numbers; a fraction is cut; overflow gives 0."""
    direct = text.try_cast(kind)
    through_decimal = text.try_cast("decimal(38,10)").try_cast(kind)
    return F.coalesce(direct, through_decimal, F.lit(0).cast(kind)), direct.isNotNull()


def decimal_number(text: Column, precision: int, scale: int) -> tuple[Column, Column]:
    kind = f"decimal({precision},{scale})"
    value = text.try_cast(kind)
    wide = text.try_cast("decimal(38,18)")
    return F.coalesce(value, F.lit(0).cast(kind)), F.coalesce(value == wide, F.lit(False))


def plain_text(text: Column) -> tuple[Column, Column]:
    return F.coalesce(text, F.lit("")), text.isNotNull()


def uuid_text(text: Column) -> tuple[Column, Column]:
    """Lower-cased; an absent id is the zero UUID. A malformed one stays and fails ``is_uuid``."""
    return F.coalesce(F.lower(text), F.lit(ZERO_UUID)), text.isNotNull()


def is_uuid(value: Column) -> Column:
    return value.rlike(UUID_PATTERN)
