import hashlib
import os
import zlib

import pytest
from pyspark.sql import functions as F

from searchshift.functions import values as v
from searchshift.functions.crc import advance


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("n, text", [
    (0, "0 B"), (512, "512 B"), (1023, "1023 B"), (1024, "1.0 KB"), (1280, "1.3 KB"),
    (2048, "2.0 KB"), (1048575, "1024.0 KB"), (1048576, "1.0 MB"), (5 << 20, "5.0 MB"),
    (1 << 30, "1.00 GB"), (3 << 30, "3.00 GB")])
def test_format_bytes(spark, n, text):
    assert one(spark, v.format_bytes(F.lit(n).cast("bigint"))) == text


def test_meta_hash(spark):
    got = one(spark, v.meta_hash(F.lit("_0.fdt"), F.lit(1234), F.lit("abc"), F.lit("9.8.0")))
    assert bytes(got) == hashlib.sha256(b"_0.fdt1234abc9.8.0").digest()


def test_stable_id_is_repeatable_and_url_safe(spark):
    first = one(spark, v.stable_id("index", F.lit("b1")))
    assert first == one(spark, v.stable_id("index", F.lit("b1")))
    assert first != one(spark, v.stable_id("snapshot", F.lit("b1")))
    assert len(first) == 22 and set(first) <= set(
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_")


def digits36(n):
    digits = "0123456789abcdefghijklmnopqrstuvwxyz"
    return (digits36(n // 36) if n >= 36 else "") + digits[n % 36]


@pytest.mark.parametrize("value", [0, 1, 35, 36, 0xDEADBEEF, 0xFFFFFFFF])
def test_stored_checksum(spark, value):
    tail = bytes.fromhex("C02893E800000000") + value.to_bytes(8, "big")
    column = v.stored_checksum(F.lit(bytearray(tail)))
    assert one(spark, column) == digits36(value)
    assert one(spark, v.checksum_value(column)) == value


@pytest.mark.parametrize("tail", [
    b"", b"short", bytes(16), bytes.fromhex("C02893E800000001") + bytes(8),
    bytes.fromhex("C02893E800000000") + (1 << 32).to_bytes(8, "big")])
def test_invalid_footer(spark, tail):
    assert one(spark, v.stored_checksum(F.lit(bytearray(tail)))) is None


@pytest.mark.parametrize("name, generation", [
    ("segments_1", 1), ("segments_z", 35), ("segments_10", 36), ("segments_1A", 46),
    ("segments_0", 0), ("segments_000000000000000002", 2), ("segments_1y2p0ij32e8e7", 2 ** 63 - 1),
    ("segments_1Y2P0IJ32E8E7", 2 ** 63 - 1), ("segments_1y2p0ij32e8e8", None), ("segments_zzzzzzzzzzzzz", None),
    ("segments_", None), ("segments.gen", None), ("segments_x-y", None), ("other", None)])
def test_commit_generation(spark, name, generation):
    assert one(spark, v.commit_generation(F.lit(name))) == generation


@pytest.mark.parametrize("version, number", [
    ("2.11.1", 2110199), ("2.0", 2000099), ("1.3.0", 1030099), ("x", None)])
def test_version_id(spark, version, number):
    assert one(spark, v.version_id(F.lit(version))) == number


def test_version_order_is_numeric(spark):
    assert one(spark, v.version_order(F.lit("10.0.0")) > v.version_order(F.lit("9.12.3")))
    assert one(spark, v.version_order(F.lit("9.0.12345")) < v.version_order(F.lit("9.1.0")))
    assert one(spark, v.version_text(v.version_order(F.lit("8.11.4")))) == "8.11.4"
    assert one(spark, v.version_text(v.version_order(F.lit(None).cast("string")))) is None


def test_json_text(spark):
    assert one(spark, v.json_text(F.lit('a"b\\c\n'))) == '"a\\"b\\\\c\\n"'


def test_crc_of_pieces():
    data = os.urandom(10_007)
    for cuts in ([0, 10_007], [0, 1, 2, 5000, 10_007], [0, 0, 10_007]):
        combined = 0
        for a, b in zip(cuts, cuts[1:]):
            combined ^= advance(zlib.crc32(data[a:b]), len(data) - b)
        assert combined == zlib.crc32(data)


def test_packed_versions(spark):
    texts = ["0.0.0", "9.0.9999", "9.0.10000", "9.1.0", "10.0.0", "2097151.2097151.2097151"]
    packed = [one(spark, v.version_order(F.lit(t))) for t in texts]
    assert packed == sorted(packed) and len(set(packed)) == len(packed)
    assert [one(spark, v.version_text(F.lit(p))) for p in packed] == texts
    for wide in ("2097152.0.0", "9.99999999999.1", "9.0.-1"):
        assert one(spark, v.version_order(F.lit(wide))) is None and not one(spark, v.version_fits(F.lit(wide)))
    for fine in ("9.8", "9.x.1", "9", None):
        assert one(spark, v.version_fits(F.lit(fine).cast("string")))
