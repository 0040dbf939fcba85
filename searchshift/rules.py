"""Fixed values. Everything here must equal what the two search engines and the
migration rules prescribe; none of it grows with the data."""

# Class substrings of the source schema and the target type of each, in match order.
CLASS_RULES = (
    ("IntPointField", "integer"),
    ("LongPointField", "long"),
    ("FloatPointField", "float"),
    ("DoublePointField", "double"),
    ("DatePointField", "date"),
    ("TrieIntField", "integer"),
    ("TrieLongField", "long"),
    ("TrieFloatField", "float"),
    ("TrieDoubleField", "double"),
    ("TrieDateField", "date"),
    ("IntField", "integer"),
    ("LongField", "long"),
    ("FloatField", "float"),
    ("DoubleField", "double"),
    ("DateField", "date"),
    ("StrField", "keyword"),
    ("TextField", "text"),
    ("BoolField", "boolean"),
    ("BinaryField", "binary"),
    ("LatLonPointSpatialField", "geo_point"),
    ("SpatialRecursivePrefixTreeFieldType", "geo_point"),
)

# Type names that decide the target type without looking at the class.
TYPE_SHORTCUTS = {
    "string": "keyword",
    "pint": "integer",
    "int": "integer",
    "plong": "long",
    "long": "long",
    "pfloat": "float",
    "float": "float",
    "pdouble": "double",
    "double": "double",
    "pdate": "date",
    "date": "date",
    "boolean": "boolean",
    "binary": "binary",
}

TEXT_PREFIX = "text_"
DEFAULT_TARGET = "keyword"
TARGET_TYPES = ("integer", "long", "float", "double", "date", "keyword", "text",
                "boolean", "binary", "geo_point")
INTERNAL_PREFIX = "_"
INTERNAL_KEPT = "_text_"

# Spark type that holds a column of each target type.
SPARK_TYPES = {
    "integer": "int",
    "long": "bigint",
    "float": "float",
    "double": "double",
    "date": "timestamp",
    "keyword": "string",
    "text": "string",
    "boolean": "boolean",
    "binary": "binary",
    "geo_point": "struct<lat:double,lon:double>",
}

# What each target type can be asked: (target type, predicate).
CAPABILITIES = tuple(
    [(t, p) for t in ("integer", "long", "float", "double") for p in ("term", "range", "aggregate")]
    + [("date", "term"), ("date", "range"), ("date", "aggregate")]
    + [("keyword", "term")]
    + [("text", "match")]
    + [("boolean", "term")]
)

# Names inside a backup.
INCREMENTAL_MARKER = "backup_0.properties"
COMPLETION_MARKER = "backup.properties"
SHARD_DIR_REGEX = r"^snapshot\.shard([0-9]+)\z"
SHARD_DIR_LOOSE_PREFIX = "snapshot.shard"
COMMIT_PREFIX = "segments_"
# The largest signed 64-bit number in base 36.
LARGEST_GENERATION = "1y2p0ij32e8e7"
STANDALONE_DIRS = ("", "index")
SCHEMA_CANDIDATES = (
    "zk_backup/configs/_default/managed-schema.xml",
    "zk_backup/configs/_default/managed-schema",
    "zk_backup_0/configs/_default/managed-schema.xml",
    "zk_backup_0/configs/_default/managed-schema",
    "conf/managed-schema.xml",
    "conf/managed-schema",
)
STATE_CANDIDATES = (
    "zk_backup/collection_state.json",
    "zk_backup_0/collection_state.json",
)

STANDALONE = "STANDALONE"
CLOUD_FULL = "SOLRCLOUD_FULL"

# Names inside a written snapshot repository.
REPO_INDEX = "index-0"
REPO_LATEST = "index.latest"
REPO_LATEST_BYTES = 8
METADATA_FILES_FIXED = 5
METADATA_FILES_PER_SHARD = 2

# Index file footer: magic and algorithm number, then eight bytes of checksum.
FOOTER_LENGTH = 16
FOOTER_LEAD_HEX = "C02893E800000000"

# Versions.
TARGET_VERSION = "2.11.1"
TARGET_VERSION_ID = 2110199
MINIMUM_MAJOR = 7
CONVERTER_MAJOR = 9
# Target version and the index library version it reads with.
TARGETS = (
    ("1.x", "8.x"),
    ("2.0", "9.1.0"),
    ("2.11.1", "9.7.0"),
    ("2.19.1", "9.10.0"),
)
# Tested combinations: source index library version, target version, outcome.
TESTED = (
    ("9.8.0", "2.11.1", "PASS"),
    ("8.11.4", "2.11.1", "PASS"),
    ("7.7.3", "2.11.1", "FAIL"),
)

BATCH_SIZE = 500
DISK_FACTOR = 1.1

# Issue codes in check order.
ISSUES = (
    ("DUPLICATE_BACKUP", "ERROR"),
    ("OUTPUT_SHARED", "ERROR"),
    ("NOT_A_DIRECTORY", "ERROR"),
    ("LISTING_FAILED", "ERROR"),
    ("INCREMENTAL_BACKUP", "ERROR"),
    ("SHARD_NUMBER_RANGE", "ERROR"),
    ("SHARD_GAP", "ERROR"),
    ("SHARD_WITHOUT_COMMIT", "ERROR"),
    ("UNKNOWN_FORMAT", "ERROR"),
    ("UNMATCHED_SHARD_DIR", "WARN"),
    ("INPUT_MISSING", "ERROR"),
    ("INPUT_UNREADABLE", "ERROR"),
    ("SHARD_DIR_MISSING", "ERROR"),
    ("SHARD_DIR_UNREADABLE", "ERROR"),
    ("OUTPUT_NOT_WRITABLE", "ERROR"),
    ("OUTPUT_NOT_EMPTY", "WARN"),
    ("LIBRARY_TOO_OLD", "ERROR"),
    ("LIBRARY_OLD", "WARN"),
    ("NO_SEGMENTS", "WARN"),
    ("NO_DOCUMENTS", "WARN"),
    ("COMMIT_UNREADABLE", "ERROR"),
    ("COMMIT_NAME_INVALID", "WARN"),
    ("LOW_DISK_SPACE", "WARN"),
    ("FILE_MISSING", "WARN"),
    ("COPY_FAILED", "ERROR"),
    ("FOOTER_INVALID", "ERROR"),
    ("CHECKSUM_MISMATCH", "ERROR"),
    ("SCHEMA_UNREADABLE", "ERROR"),
    ("SCHEMA_MISSING", "WARN"),
    ("TYPE_UNKNOWN", "WARN"),
    ("FIELD_NAME_EMPTY", "WARN"),
    ("WRITE_FAILED", "ERROR"),
    ("REPO_INDEX_MISSING", "ERROR"),
    ("REPO_LATEST_MISSING", "ERROR"),
    ("REPO_SNAPSHOT_MISSING", "ERROR"),
    ("REPO_METADATA_MISSING", "ERROR"),
    ("REPO_LATEST_SIZE", "ERROR"),
    ("INDICES_DIR_MISSING", "ERROR"),
    ("INDEX_DIR_MISSING", "ERROR"),
    ("INDEX_DIR_MULTIPLE", "WARN"),
    ("INDEX_METADATA_MISSING", "ERROR"),
    ("OUTPUT_SHARD_MISSING", "ERROR"),
    ("SHARD_SNAPSHOT_MISSING", "ERROR"),
    ("SHARD_INDEX_MISSING", "ERROR"),
    ("SHARD_FILES_MISSING", "WARN"),
    ("VERSION_RANGE", "ERROR"),
)
SEVERITY = dict(ISSUES)
CHECK_ORDER = {code: i + 1 for i, (code, _) in enumerate(ISSUES)}
