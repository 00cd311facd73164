"""Scalar expressions shared by the operators (null, infinity and rounding rules included)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Splice tags that end a feature name, and their meaning.
SPLICE_TAGS = {"S": "spliced", "U": "unspliced", "A": "ambiguous"}

INF = float("inf")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---- names and keys -------------------------------------------------------------------------

def feature_gene(feature) -> Column:
    """Gene name without its splice suffix (``_S``, ``_U``, ``_A``)."""
    return F.regexp_replace(_c(feature), "_[SUA]$", "")


def feature_splice(feature) -> Column:
    """Splice tag at the end of a feature name, NULL when there is none."""
    return F.nullif(F.regexp_extract(_c(feature), "_([SUA])$", 1), F.lit(""))


def before_first(text, sep: str = "_") -> Column:
    return F.substring_index(_c(text), sep, 1)


def after_last(text, sep: str = "_") -> Column:
    return F.substring_index(_c(text), sep, -1)


def symbol_of(gene_id) -> Column:
    """Symbol part of ``symbol_ENS...``."""
    return F.regexp_replace(_c(gene_id), "_ENS.*$", "")


def strip_prefix_once(text, prefix: str) -> Column:
    """Remove ``prefix`` when the text starts with it; only the first occurrence."""
    t = _c(text)
    return F.when(t.startswith(prefix), F.substring(t, len(prefix) + 1, 2**31 - 1 - len(prefix))).otherwise(t)


def clean_label(text) -> Column:
    """Lower-case, trimmed, blanks to underscores."""
    return F.translate(F.trim(F.lower(_c(text))), " ", "_")


def zero_pad(number, width: int = 2) -> Column:
    """Left-pad with zeros without cutting longer numbers."""
    t = _c(number).cast("string")
    return F.when(F.length(t) >= width, t).otherwise(F.lpad(t, width, "0"))


def make_key(*parts, sep: str = "_") -> Column:
    return F.concat_ws(sep, *[_c(p) for p in parts])


def csv_contains(text, value) -> Column:
    """Membership of ``value`` in a comma-joined list."""
    return F.array_contains(F.split(_c(text), ","), value)


def short_name(text, n: int) -> Column:
    return F.substring(_c(text), 1, n)


def resolution_of(column_name) -> Column:
    """Resolution in a cluster column name such as ``RNA_snn_res.0.5``."""
    return F.regexp_extract(_c(column_name), r"res\.(.+)$", 1)


def cut_side(name) -> Column:
    return F.regexp_extract(_c(name), "(min|max)", 1)


def cut_metric(name) -> Column:
    return F.regexp_extract(_c(name), "^(.+)_(?:min|max)$", 1)


def is_date_stamp(text) -> Column:
    """``20YY-MM-DD`` text that is also a real date."""
    t = _c(text)
    # Fixed value: format of a date stamp.
    return t.rlike("^20[0-9]{2}-[0-9]{2}-[0-9]{2}$") & F.try_to_timestamp(t, F.lit("yyyy-MM-dd")).isNotNull()


def json_number(text, path: str, default: float = 0) -> Column:
    return F.coalesce(F.get_json_object(_c(text), path).try_cast("double"), F.lit(float(default)))


def recode(column, lookup: Mapping[str, str]) -> Column:
    """Value lookup; values outside the lookup stay as they are."""
    c = _c(column)
    pairs = [F.lit(x) for kv in lookup.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), c), c)


def parse_flag(text) -> Column:
    """String booleans (true/false/yes/no/1/0, any case) to BOOLEAN; others NULL."""
    return F.trim(F.lower(_c(text).cast("string"))).try_cast("boolean")


# ---- numbers --------------------------------------------------------------------------------

def logit(p) -> Column:
    """log(p / (1 - p)), -inf at 0 and +inf at 1."""
    x = _c(p)
    return (
        F.when(x <= 0, F.lit(-INF))
        .when(x >= 1, F.lit(INF))
        .otherwise(F.ln(x / F.when(x < 1, 1 - x)))
    )


def inv_logit(x) -> Column:
    return 1.0 / (1.0 + F.exp(-_c(x)))


def share_logit(part, whole) -> Column:
    """logit of (part + 1) / (whole + 2), finite for every count."""
    return logit((_c(part) + 1.0) / (_c(whole) + 2.0))


def log10_or_neg_inf(x) -> Column:
    v = _c(x)
    return F.when(v <= 0, F.lit(-INF)).otherwise(F.log10(F.when(v > 0, v)))


def safe_ratio(num, den) -> Column:
    """num / den, 0 where den is 0."""
    d = _c(den)
    return F.when(d == 0, F.lit(0.0)).otherwise(_c(num) / F.when(d != 0, d))


def clamp(x, lo: float, hi: float) -> Column:
    return F.least(F.greatest(_c(x), F.lit(lo)), F.lit(hi))


def round_half_even(x, digits: int = 0) -> Column:
    return F.bround(_c(x), digits)


def significant(x, digits: int) -> Column:
    """Round to a number of significant digits."""
    v = _c(x)
    power = F.floor(F.log10(F.when(v != 0, F.abs(v)))) - (digits - 1)
    scale = F.pow(F.lit(10.0), power)
    return F.when(v == 0, F.lit(0.0)).otherwise(F.round(F.round(v / scale, 9), 0) * scale)


def signed_log10(p, effect) -> Column:
    """log10(p) with the sign of the effect; strongest increases first when sorted ascending."""
    return F.log10(F.when(_c(p) > 0, _c(p))) * F.signum(_c(effect))


def right_closed_bin(x, breaks: Sequence[float]) -> Column:
    """Label ``<=b`` of the first break (after the lowest) not below x; outside all breaks NULL."""
    v = _c(x)
    out = F.when(v <= breaks[0], F.lit(None).cast("string"))
    for b in breaks[1:]:
        label = "<=Inf" if b == INF else f"<={b:g}"
        out = out.when(v <= b, F.lit(label))
    return out


def inside(x, lo, hi) -> Column:
    """Inclusive interval; a missing end is open."""
    v = _c(x)
    return (v >= F.coalesce(_c(lo), F.lit(-INF))) & (v <= F.coalesce(_c(hi), F.lit(INF)))


def below(x, lo, eps: float = 1e-10) -> Column:
    """Strictly under ``lo`` by more than ``eps``."""
    return (_c(x) + eps) < _c(lo)


def above(x, hi, eps: float = 1e-10) -> Column:
    return (_c(x) - eps) > _c(hi)


def entropy_term(p) -> Column:
    """p * log2(p), 0 where p is 0."""
    v = _c(p)
    return F.when(v > 0, v * F.log2(F.when(v > 0, v))).otherwise(F.lit(0.0))


def stars(p) -> Column:
    """Significance stars at 0.05, 0.01 and 0.001."""
    v = _c(p)
    return F.when(v > 0.05, "").when(v > 0.01, "*").when(v > 0.001, "**").otherwise("***")


def ln_factorial(n) -> Column:
    """ln(n!) by Stirling's series, shifted by 8 so that small n are exact to about 1e-13."""
    m = _c(n).cast("double")
    z = m + 8.0
    series = (
        z * F.ln(z) - z + 0.5 * F.ln(z * 6.283185307179586)
        + 1.0 / (12.0 * z) - 1.0 / (360.0 * z * z * z) + 1.0 / (1260.0 * z * z * z * z * z)
    )
    shift = F.ln(m + 1.0)
    for k in range(2, 9):
        shift = shift + F.ln(m + float(k))
    return series - shift
