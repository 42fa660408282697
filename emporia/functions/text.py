"""String helpers: IP region text, URL completion, percent text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's output.
UNKNOWN = "未知"  # "unknown" region label
PROVINCE = "省"  # province marker
AUTONOMOUS_REGION = "自治区"  # autonomous-region marker
CITY = "市"  # city marker
MISSING = "数据缺失"  # "data missing" sentinel in Top-N id lists
PATH_ARROW = "→"  # joins two page types in a path


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def region_parts(region) -> tuple[Column, Column, Column]:
    """Region text ``a|b|c|...`` -> (province, city, full_region).

    The first ``|`` part that contains a province, autonomous-region or city
    marker is the address.  Province ends at the first province marker (or
    autonomous-region marker); the rest is the city, or the province again
    when nothing follows.  A part with only a city marker is both.  No
    address gives the unknown label for all three.
    """
    parts = F.split(_col(region), r"\|")
    addr = F.get(
        F.filter(
            parts,
            lambda p: p.contains(PROVINCE) | p.contains(AUTONOMOUS_REGION) | p.contains(CITY),
        ),
        0,
    )
    prov_pos = F.instr(addr, PROVINCE)
    auto_pos = F.instr(addr, AUTONOMOUS_REGION)
    prov_end = F.when(prov_pos > 0, prov_pos).when(auto_pos > 0, auto_pos + 2)
    province = F.when(prov_end.isNotNull(), F.substring(addr, F.lit(1), prov_end)).otherwise(addr)
    rest = F.when(prov_end.isNotNull(), F.substring(addr, prov_end + 1, F.lit(1 << 20)))
    city = F.when(F.length(rest) > 0, rest).otherwise(province)
    province = F.coalesce(province, F.lit(UNKNOWN))
    city = F.coalesce(city, F.lit(UNKNOWN))
    full = F.when(city == province, province).otherwise(F.concat(province, city))
    return province, city, full


def strip_ws(c) -> Column:
    """Remove leading and trailing whitespace (not only spaces)."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def unescape_html(c) -> Column:
    """Decode the five predefined HTML entities (``&amp;`` last)."""
    out = _col(c)
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out


def url_origin(url) -> Column:
    """``scheme://host[:port]`` of an absolute URL ('' when not absolute)."""
    return F.regexp_extract(_col(url), r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", 1)


def absolute_url(href, base) -> Column:
    """``/x`` -> base + ``/x``; ``info/x`` -> base + ``/info/x``; else as is.

    ``base`` is a site root (string) or a column of roots.
    """
    href = strip_ws(href)
    root = F.lit(base.rstrip("/")) if isinstance(base, str) else _col(base)
    return (
        F.when(href.startswith("/"), F.concat(root, href))
        .when(href.startswith("info/"), F.concat(root, F.lit("/"), href))
        .otherwise(href)
    )


def growth_rate(cur, prev) -> Column:
    """((cur - prev) / prev) * 100 rounded to 2; null when prev is null or 0."""
    cur, prev = _col(cur), _col(prev)
    ratio = (cur - prev).cast("double") / prev.cast("double") * 100
    return F.when(prev.isNull() | (prev == 0), F.lit(None)).otherwise(F.round(ratio, 2))


def percent_text(x) -> Column:
    """number -> ``'12.34%'`` with two decimals; null stays null."""
    x = _col(x)
    return F.when(x.isNull(), F.lit(None)).otherwise(F.format_string("%.2f%%", x))
