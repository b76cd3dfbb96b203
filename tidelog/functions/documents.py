"""Identity of a search document."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_DELIMITER = "$"


def document_id(*keys: Column) -> Column:
    """The key values joined by ``$``; NULL as soon as one of them is NULL.

    ``concat_ws`` alone would skip a NULL and let two different keys collide.
    """
    known = keys[0].isNotNull()
    for key in keys[1:]:
        known = known & key.isNotNull()
    return F.when(known, F.concat_ws(KEY_DELIMITER, *[key.cast("string") for key in keys]))
