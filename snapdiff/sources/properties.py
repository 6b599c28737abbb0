"""Feed properties: from a property table and a run date to feed descriptions."""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import DataFrame, Row, functions as F, types as T

from ..functions.dates import snapshot_days, snapshot_path
from ..model import ConfigError, FeedSpec

# Property names, by what they are used for.
_TEXT = {
    "app_name": "sparkAppName",
    "output_delimiter": "sparkDelimiterOutput",
    "source_delimiter": "sparkDelimiterSource",
    "additional_output": "sparkAdditionalOutput",
    "feed": "sparkLookupTableName",
    "record_regex": "sparkRegexValidation",
    "replacements_json": "sparkJSONReplacement",
    "formats_json": "sparkJSONFormating",
    "validations_json": "sparkJSONValidation",
    "source_type": "sparkSourceType",
    "output_bucket": "sparkOutputBucket",
    "bad_bucket": "sparkBadBucket",
}
_INT_FLAGS = {
    "reseed": "sparkFlagReseed",
    "format_data": "sparkFlagFormatData",
    "formats_from_argument": "sparkFlagJSONStringFormatting",
    "validate": "sparkFlagValidateRecords",
    "regex_validation": "sparkFlagRegexValidation",
    "replace_data": "sparkFlagReplaceData",
}
_TEXT_FLAGS = {
    "csv_header": "sparkCsvHasHeader",
    "delete_before_write": "sparkBucketDeleteBeforeWrite",
}
# Properties of this engine, all optional: reader, output and comparison settings.
_MORE = {
    "multi_line": ("sparkCsvMultiLine", lambda v: v != "0"),
    "csv_options": ("sparkCsvOptions", json.loads),
    "output_files": ("sparkOutputFiles", int),
    "rows_per_file": ("sparkRowsPerFile", int),
    "comparison": ("sparkComparison", str),
    "manifest_path": ("sparkManifestPath", str),
    "keep_versions": ("sparkKeepVersions", int),
    "kept_path": ("sparkKeptPath", str),
    "kept_buckets": ("sparkKeptBuckets", int),
}
_FOLDERS = (
    "sparkBasePath", "sparkRawPreviousPath", "sparkRawCurrentPath", "sparkDeltaDataPath",
    "sparkBadRecordsPath", "sparkAuditRecordsPath", "sparkConfigurationPath", "sparkFileFormat",
    "sparkInputBucketFolder", "sparkDeltaDeletePath", "sparkDeltaBadPath",
)


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


PROPERTY_SCHEMA = T.StructType([
    *_strings("id", "appType", "actionOnFailure", "sparkFileName", "sparkBusinessProperty"),
    T.StructField("sparkCommandLineArguments", T.StructType(
        _strings(*_FOLDERS, *_TEXT.values(), *_INT_FLAGS.values(), *_TEXT_FLAGS.values(),
                 *(key for key, _ in _MORE.values())))),
])


def select_properties(table: DataFrame, workflow: str, business_property: str) -> DataFrame:
    """Property rows of one workflow and business property."""
    return table.where(
        (F.col("sparkFileName") == workflow) & (F.col("sparkBusinessProperty") == business_property))


def dated_name(template: str, day: date) -> str:
    """A name template with its year, month and day slots filled."""
    return template.format(f"{day:%Y}", f"{day:%m}", f"{day:%d}")


def feed_spec(row: Row, run_date: date, current_days: int, previous_days: int) -> FeedSpec:
    """The description of one feed's run on one date."""
    p = row["sparkCommandLineArguments"].asDict()
    current, previous = snapshot_days(run_date, current_days, previous_days)
    base = p["sparkBasePath"]

    def on(day: date, folder: str, root: str = base) -> str:
        return snapshot_path(root, p[folder], day)

    try:
        flags = {name: bool(int(p[key])) for name, key in _INT_FLAGS.items()}
    except (TypeError, ValueError) as err:
        raise ConfigError(f"property row {row['id']!r} has a flag that is not an integer") from err
    return FeedSpec(
        previous_path=on(previous, "sparkRawPreviousPath"),
        current_path=on(current, "sparkRawCurrentPath"),
        inserts_path=on(current, "sparkDeltaDataPath") + "inserts/",
        deletes_path=on(current, "sparkDeltaDataPath") + "deletes/",
        bad_path=on(current, "sparkBadRecordsPath"),
        audit_path=on(current, "sparkAuditRecordsPath"),
        config_path=base + p["sparkConfigurationPath"],
        year=f"{current:%Y}", month=f"{current:%m}", day=f"{current:%d}",
        file_name=dated_name(p["sparkFileFormat"], current),
        input_folder=base + dated_name(p["sparkInputBucketFolder"], current),
        delta_prefix=on(current, "sparkDeltaDeletePath", ""),
        bad_prefix=on(current, "sparkDeltaBadPath", ""),
        **{name: p[key] or "" for name, key in _TEXT.items()},
        **flags,
        **{name: p[key] == "1" for name, key in _TEXT_FLAGS.items()},
        **{name: read(p[key]) for name, (key, read) in _MORE.items() if p.get(key)},
        **({"on_failure": row["actionOnFailure"]} if row["actionOnFailure"] else {}),
    )


def feed_specs(table: DataFrame, workflow: str, business_property: str, run_date: date,
               current_days: int, previous_days: int) -> list[FeedSpec]:
    """One description per matching property row."""
    rows = select_properties(table, workflow, business_property).collect()
    if not rows:
        raise ConfigError(f"no feeds for workflow {workflow!r}, property {business_property!r}")
    return [feed_spec(row, run_date, current_days, previous_days) for row in rows]
