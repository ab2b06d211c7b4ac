"""Privacy packets: JSON documents with a binding and a list of records.

A packet is one document, over several lines; a folder holds any number of them.  The records
are read as variants, so a value of a wrong type makes an error of its own row and not of the
packet, and a document that is no packet becomes a row with its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fields of a record, their names here and their types; the last three may be missing.
FIELDS = (
    ("sourceRecordRef", "source_record_ref", "string"), ("subjectRef", "subject_ref", "string"), ("featureId", "feature_id", "string"), ("dataState", "data_state", "string"),
    ("occurredAt", "occurred_at", "timestamp"), ("retentionDays", "retention_days", "int"), ("expiryAction", "expiry_action", "string"), ("anonymizationTarget", "anonymization_target", "string"),
    ("anonymousGroup", "anonymous_group", "string"), ("cellCount", "cell_count", "int"), ("candidateIdentifierFree", "candidate_identifier_free", "boolean"), ("methodVersion", "method_version", "string"),
    ("evidenceId", "evidence_id", "string"), ("demographicOrRareCell", "demographic_or_rare_cell", "boolean"), ("requestType", "request_type", "string"), ("privateRecapCounter", "private_recap_counter", "boolean"),
)
REQUIRED = 13
#: Type names that a variant shows for what a field may hold.
SHOWN = {"string": "STRING", "timestamp": "STRING", "int": "BIGINT", "boolean": "BOOLEAN"}
SCHEMA = "schemaVersion string, sourceBinding variant, records array<variant>, _corrupt string"


def read_packets(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: 13 required and 3 optional fields, and ``field_error``, which names the first field that is missing or of a wrong type."""
    packets = spark.read.schema(SCHEMA).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    rows = packets.select("_corrupt", F.explode_outer("records").alias("r"))
    of = lambda f: F.try_variant_get("r", f"$.{f}", "variant")
    kind = lambda f: F.coalesce(F.schema_of_variant(of(f)), F.lit("VOID"))

    def value(field: str, to: str) -> Column:
        text = F.when(kind(field).startswith(SHOWN[to]), F.try_variant_get("r", f"$.{field}", "string" if to == "timestamp" else to))
        if to == "timestamp":
            text = F.when(text.rlike(r"(Z|[+-]\d\d:?\d\d)$"), F.try_to_timestamp(text))
        return F.coalesce(text, F.lit(False)) if field in ("demographicOrRareCell", "privateRecapCounter") else text

    def wrong(i: int, field: str, to: str) -> Column:
        bad = ~kind(field).startswith(SHOWN[to])
        if to == "timestamp":
            bad = bad | value(field, to).isNull()
        if to == "int":
            bad = bad | value(field, to).isNull()  # beyond 32 bits
        if to == "string" and i < REQUIRED:
            bad = bad | (F.trim(value(field, to)) == "")
        return F.when(bad & (F.lit(i < REQUIRED) | (kind(field) != "VOID")), field)

    errors = [F.when(F.col("r").isNull(), "records"), *[wrong(i, f, to) for i, (f, _, to) in enumerate(FIELDS)]]
    return rows.select(*[value(f, to).alias(name) for f, name, to in FIELDS], F.coalesce(*errors).alias("field_error"), F.when(F.col("r").isNull(), F.coalesce("_corrupt", F.lit(""))).alias("corrupt_packet"))


def packet_texts(records: DataFrame, packet: Column, faulty: Column) -> DataFrame:
    """``records`` (with the names of this library) as packets, one document for each value of ``packet``, which must bound their size.

    faulty: records whose ``cellCount`` is written as a text.
    """
    iso = F.date_format("occurred_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    fields = {f: iso if to == "timestamp" else F.col(name) for f, name, to in FIELDS}
    as_json = lambda of: F.parse_json(F.to_json(F.struct(*[c.alias(f) for f, c in of.items()])))
    record = F.when(faulty, as_json(fields | {"cellCount": F.col("cell_count").cast("string")})).otherwise(as_json(fields))
    body = F.struct(F.lit("privacy-packet.v1").alias("schemaVersion"), F.struct(F.min("occurred_at").alias("start"), F.max("occurred_at").alias("end")).alias("sourceBinding"), F.collect_list(record).alias("records"))
    return records.groupBy(packet.alias("packet")).agg(F.to_json(body, {"pretty": "true"}).alias("value"))


def write_packets(records: DataFrame, packet: Column, path: str, faulty: Column | None = None) -> None:
    """A file for each packet."""
    texts = packet_texts(records, packet, F.lit(False) if faulty is None else F.coalesce(faulty, F.lit(False)))
    texts.repartition("packet").write.partitionBy("packet").text(path)
