"""Names of files of a bucket."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import slug


def bucket_stem(kind: str, part: Column) -> Column:
    """``{kind}-{domain}-script_..-lang_..-source_..-len_..-part_0001-{digest}``; ``part`` counts from 0.

    The digest is of all five axes, so slugs that agree don't make names agree.
    """
    key = F.to_json(F.struct("domain", "script", "language_hint", "source_group", "length_bin"))
    return F.format_string(
        f"{kind}-%s-script_%s-lang_%s-source_%s-len_%s-part_%04d-%s",
        F.col("domain"), slug(F.col("script")), slug(F.col("language_hint")), slug(F.col("source_group")), F.col("length_bin"), part.cast("int") + 1, F.substring(F.sha2(key, 256), 1, 8),
    )
