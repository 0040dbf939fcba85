"""Column expressions: sizes, hashes, identifiers, versions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules

KIB, MIB, GIB = 1024, 1024 ** 2, 1024 ** 3


def format_bytes(n: Column) -> Column:
    """Human-readable size; one decimal up to MB, two for GB, halves rounded up."""
    return (
        F.when(n < KIB, F.concat(n.cast("string"), F.lit(" B")))
        .when(n < MIB, F.format_string("%.1f KB", n / F.lit(float(KIB))))
        .when(n < GIB, F.format_string("%.1f MB", n / F.lit(float(MIB))))
        .otherwise(F.format_string("%.2f GB", n / F.lit(float(GIB))))
    )


def meta_hash(name: Column, length: Column, checksum: Column, written_by: Column) -> Column:
    """SHA-256 over the four attributes as text, without separators."""
    return F.unhex(F.sha2(F.concat(name, length.cast("string"), checksum, written_by), 256))


def stable_id(*parts: Column | str) -> Column:
    """22-character URL-safe identifier derived from its parts, so that a rerun
    writes the same names."""
    columns = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    digest = F.sha2(F.concat_ws("/", *columns), 256)
    return F.translate(F.base64(F.unhex(F.substring(digest, 1, 32))), "+/=", "-_")


def base36(raw: Column) -> Column:
    """Unsigned base-36 text of up to eight bytes, lower case."""
    return F.lower(F.conv(F.hex(raw), 16, 36))


def stored_checksum(tail: Column) -> Column:
    """Checksum text held by the last 16 bytes of an index file; NULL where the
    bytes are not a footer or hold more than 32 bits."""
    valid = (
        (F.octet_length(tail) == rules.FOOTER_LENGTH)
        & (F.hex(F.substring(tail, 1, 8)) == rules.FOOTER_LEAD_HEX)
        & (F.hex(F.substring(tail, 9, 4)) == "00000000")
    )
    return F.when(valid, base36(F.substring(tail, 9, 8)))


def checksum_value(text: Column) -> Column:
    """Number behind a base-36 checksum text."""
    return F.conv(text, 36, 10).cast("bigint")


def commit_generation(name: Column) -> Column:
    """Generation of a commit file, up to the largest 64-bit number; NULL for any other name."""
    digits = F.lower(F.regexp_extract(name, r"^segments_0*([0-9a-zA-Z]{1,13})\z", 1))
    fits = (F.length(digits) < len(rules.LARGEST_GENERATION)) | (digits <= rules.LARGEST_GENERATION)
    return F.when((digits != "") & fits, F.conv(digits, 36, 10).cast("bigint"))


def version_part(version: Column, index: int) -> Column:
    """One number of a dotted version; NULL where it is absent or not a number."""
    piece = F.try_element_at(F.split(version, r"\."), F.lit(index + 1))
    return piece.try_cast("int")


#: Bits of each number of a packed version.
VERSION_BITS = 21


def version_order(version: Column) -> Column:
    """A version as one number that sorts like it: a maximum over it is a hash aggregation. NULL for NULL and for
    a version with a number that does not fit; ``version_fits`` tells them apart."""
    parts = [F.coalesce(version_part(version, i), F.lit(0)).cast("bigint") for i in range(3)]
    major, minor, patch = parts
    packed = F.shiftleft(major, 2 * VERSION_BITS) + F.shiftleft(minor, VERSION_BITS) + patch
    return F.when(version.isNotNull() & version_fits(version), packed)


def version_fits(version: Column) -> Column:
    """Whether every number of a version can be packed; true for NULL."""
    fits = F.lit(True)
    for i in range(3):
        piece = F.try_element_at(F.split(version, r"\."), F.lit(i + 1))
        # more digits than an int has give no number at all
        large = piece.rlike(r"^0*[1-9][0-9]{9,}\z") | ~version_part(version, i).between(0, (1 << VERSION_BITS) - 1)
        fits = fits & ~F.coalesce(large, F.lit(False))
    return fits


def version_text(order: Column) -> Column:
    """Inverse of ``version_order``."""
    part = lambda bits: F.shiftright(order, bits).bitwiseAND((1 << VERSION_BITS) - 1).cast("string")
    return F.when(order.isNotNull(), F.concat_ws(".", part(2 * VERSION_BITS), part(VERSION_BITS), part(0)))


def version_id(version: Column) -> Column:
    """Numeric release identifier, such as 2110199 for 2.11.1."""
    major, minor, patch = (F.coalesce(version_part(version, i), F.lit(0)) for i in range(3))
    return F.when(version_part(version, 0).isNotNull(),
                  major * 1_000_000 + minor * 10_000 + patch * 100 + 99)


def join_path(directory: Column, name: Column) -> Column:
    return F.when(directory == "", name).otherwise(F.concat(directory, F.lit("/"), name))


def json_text(text: Column) -> Column:
    """Text as a quoted JSON string."""
    whole = F.to_json(F.struct(text.alias("k")))
    return F.substring(whole, F.lit(6), F.length(whole) - 6)


def utc_wall_clock(instant: Column) -> Column:
    """UTC date and time of an instant, whatever the session's time zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))
