"""Expressions over versions, persistent URLs, sizes and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Package sizes in stream elements, their short names, and the sample positions: fixed values.
PACKAGE_SIZES = {10_000: "10K", 100_000: "100K", 1_000_000: "1M", 10_000_000: "10M", 100_000_000: "100M", 1_000_000_000: "1B"}
SAMPLES = (0, 10, 100, 1000, 10_000)
ROOT = "https://example.org/bench/"
_KINDS = ("categories", "tasks", "profiles")
_UNITS = ("B", "KB", "MB", "GB", "TB", "PB", "EB", "ZB", "YB")


def semver_key(version: Column) -> Column:
    """A struct that orders versions; null if it is none. ``dev`` is above all; an absent suffix is the empty one."""
    pattern = r"^([0-9]+)\.([0-9]+)\.([0-9]+)(.*)$"
    part = lambda k: F.regexp_extract(version, pattern, k)
    dev = F.struct(F.lit(True).alias("is_dev"), *[F.lit(0).alias(n) for n in ("major", "minor", "patch")], F.lit("").alias("suffix"))
    stable = F.struct(F.lit(False).alias("is_dev"), *[part(k).cast("int").alias(n) for k, n in ((1, "major"), (2, "minor"), (3, "patch"))], part(4).alias("suffix"))
    return F.when(version == "dev", dev).when(version.rlike(pattern), stable)


def make_purl(kind: Column, ident: Column, version: Column, subpage: Column | None = None, root: str = ROOT) -> Column:
    """The persistent URL of a category, task, profile, dataset, schema or of the whole suite (kind ``main``)."""
    tail = F.lit("") if subpage is None else F.when(subpage.isNull(), "").otherwise(F.concat(F.lit("/"), subpage))
    return (
        F.when(kind.isin(*_KINDS), F.concat(F.lit(root + "v/"), version, F.lit("/"), kind, F.lit("/"), ident, tail))
        .when(kind == "datasets", F.concat(F.lit(root + "datasets/"), ident, F.lit("/"), version, tail))
        .when(kind == "schema", F.concat(F.lit(root + "schema/"), ident, F.lit("/"), version))
        .when((kind == "main") & (version == "dev"), F.lit(root))
        .when(kind == "main", F.concat(F.lit(root + "v/"), version))
    )


def parse_purl(url: Column, root: str = ROOT, suite: str = "suite") -> Column:
    """struct(kind, id, version) of a persistent URL, or null. A fragment does not matter; a schema without version is dev."""
    lead = "^" + root.replace(".", r"\.")
    forms = (
        (lead + r"v/([a-z0-9.]+)/(categories|tasks|profiles)/([a-z0-9-]+)(#.*)?$", lambda g: (g(2), g(3), g(1))),
        (lead + r"datasets/([a-z0-9-]+)/([a-z0-9.]+)(#.*)?$", lambda g: (F.lit("datasets"), g(1), g(2))),
        (lead + r"schema/([a-z0-9-]+)/?([a-z0-9.]+)?(#.*)?$", lambda g: (F.lit("schema"), g(1), F.when(g(2) == "", "dev").otherwise(g(2)))),
        (lead + "$", lambda g: (F.lit("main"), F.lit(suite), F.lit("dev"))),
        (lead + r"v/([a-z0-9.]+)(#.*)?$", lambda g: (F.lit("main"), F.lit(suite), g(1))),
    )
    out = None
    for pattern, parts in forms:
        kind, ident, version = parts(lambda k, p=pattern: F.regexp_extract(url, p, k))
        found = F.struct(kind.alias("kind"), ident.alias("id"), version.alias("version"))
        out = F.when(url.rlike(pattern), found) if out is None else out.when(url.rlike(pattern), found)
    return out


def human_size(size: Column, full_name: bool = False) -> Column:
    """10K to 1B; other sizes as Full or as the number."""
    other = F.lit("Full") if full_name else size.cast("string")
    out = None
    for n, name in PACKAGE_SIZES.items():
        out = F.when(size == n, name) if out is None else out.when(size == n, name)
    return out.otherwise(other)


def human_bytes(size: Column) -> Column:
    """In steps of 1024 with one decimal."""
    out = None
    for k, unit in enumerate(_UNITS):
        text = F.format_string(f"%.1f {unit}", size.cast("double") / float(1024**k))
        out = F.when(size < float(1024 ** (k + 1)), text) if out is None else out.when(size < float(1024 ** (k + 1)), text) if k + 1 < len(_UNITS) else out.otherwise(text)
    return out


def group_digits(number: Column) -> Column:
    return F.format_number(number.cast("long"), 0)


def format_double(text: Column) -> Column:
    """Two decimals and thousands commas; the input where it is no number."""
    value = text.try_cast("double")
    return F.when(value.isNull(), text).otherwise(F.format_string("%,.2f", value))


def readable_stream_name(name: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(name, "([A-Z0-9])", " $1")))


def local_id(file_name: Column) -> Column:
    return F.lower(F.replace(F.split_part(file_name, F.lit("."), F.lit(1)), F.lit("_"), F.lit("-")))


def date_part(stamp: Column) -> Column:
    return F.split_part(stamp, F.lit("T"), F.lit(1))


def doc_weight(size: Column, total: Column) -> Column:
    """0 for the full size, else one more than the digits that the size has fewer than the total."""
    return F.when(size == total, 0).otherwise(F.length(total.cast("string")) - F.length(size.cast("string")) + 1)


def distribution_weight(size: Column, total: Column, kind: Column) -> Column:
    """Three times ``doc_weight`` and the weight of the distribution's type."""
    return doc_weight(size, total) * 3 + F.when(kind == "flat", 0).when(kind == "stream", 1).otherwise(2)


def distribution_title(size: Column, total: Column, kind: Column) -> Column:
    lead = F.when(size == total, "Full").otherwise(F.concat(human_size(size), F.lit(" elements")))
    return F.concat(lead, F.lit(" "), F.when(kind == "jelly", "Jelly").otherwise(kind), F.lit(" distribution"))


def element_id_of(file_name: Column) -> Column:
    """The element number in a name like 0000000042.ttl; null for other names."""
    digits = F.regexp_extract(file_name, r"(?:^|/)([0-9]{10})\.(ttl|trig)$", 1)
    return F.when(digits != "", digits.cast("long"))


def element_path(element_id: Column, levels: int, extension: str = "ttl") -> Column:
    """The path of an element in an archive of ``levels`` levels of directories of three digits."""
    name = F.lpad(element_id.cast("string"), 10, "0")
    dirs = [F.substring(name, 11 - 3 * (d + 1), 3) for d in range(levels, 0, -1)]
    return F.concat_ws("/", *dirs, F.concat(name, F.lit("." + extension)))


def directory_levels(elements: int) -> int:
    """Levels of directories for an archive of so many elements."""
    import math

    return max(0, math.floor(math.log10(elements - 1) / 3)) if elements > 1 else 0


def stream_format(kind: Column, is_triples: Column) -> Column:
    """struct(extension, media_type) of a distribution by its type and whether its elements are triples."""

    def of(extension: str, media: str) -> Column:
        return F.struct(F.lit(extension).alias("extension"), F.lit(media).alias("media_type"))

    return (
        F.when((kind == "flat") & is_triples, of("nt.gz", "application/n-triples"))
        .when(kind == "flat", of("nq.gz", "application/n-quads"))
        .when((kind == "stream") & is_triples, of("tar.gz", "text/turtle"))
        .when(kind == "stream", of("tar.gz", "application/trig"))
        .otherwise(of("jelly.gz", "application/x-jelly-rdf"))
    )
