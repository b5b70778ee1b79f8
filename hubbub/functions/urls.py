"""Address expressions."""

from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def canonical_url(c):
    """Without the query and with one closing slash if it had none."""
    base = F.split_part(_col(c), F.lit("?"), F.lit(1))
    return F.when(base.endswith("/"), base).otherwise(F.concat(base, F.lit("/")))


def rewrite_host(c, old, new):
    """Replace a host name wherever it stands in the address."""
    return F.replace(_col(c), F.lit(old), F.lit(new))


def absolute_url(base, href):
    """'./x' and '/x' below a base address."""
    return F.concat(F.lit(base), F.replace(_col(href), F.lit("./"), F.lit("/")))


def post_id(c, marker="/p/"):
    """Text after the last marker and before the query."""
    return F.split_part(F.substring_index(_col(c), marker, -1), F.lit("?"), F.lit(1))
