"""Extracts and full-refresh loads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import newer_than
from millrace.operators.merge import merge_upsert
from millrace.session import cut_lineage
from millrace.operators.rows import require
from millrace.sources.snapshots import merge_buckets as merge_versions
from millrace.sources.snapshots import read_table
from millrace.sources.schemas import TABLES, cast_to, schema_of


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the driver's tables with its declared schema (no footer inference)."""
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def extract_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    **options: str,
) -> DataFrame:
    """Parallel read of a database table or query in ``partitions`` key ranges.

    Filters and columns asked of the result are pushed to the database.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", query)
    reader = reader.option("partitionColumn", partition_column).option("numPartitions", partitions)
    reader = reader.option("lowerBound", lower).option("upperBound", upper)
    # tinyint(1) holds codes, not booleans (a property of the MySQL driver); rows stream in fetches.
    reader = reader.option("tinyInt1isBit", "false").option("fetchsize", 10_000).options(**options)
    return reader.load()


def extract_filtered(df: DataFrame, columns: Sequence[str] | None, predicate: Column | None):
    """Columns and rows the target needs; both reach the scan."""
    if predicate is not None:
        df = df.filter(predicate)
    return df.select(*columns) if columns else df


def extract_lookback(df: DataFrame, column: str, as_of: str, interval: str = "1 month") -> DataFrame:
    return df.filter(newer_than(column, as_of, interval))


def extract_latest_n(
    df: DataFrame, column: str, as_of: str, n: int, tie: str, interval: str = "1 month"
) -> DataFrame:
    """The newest ``n`` rows of the window (a top-k report), ties broken by ``tie``."""
    recent = extract_lookback(df, column, as_of, interval)
    return recent.orderBy(F.desc(column), F.desc(tie)).limit(n)


def _filesystem(spark: SparkSession, path: str):
    """Hadoop file system and path object behind ``path``."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Versions under ``root`` whose write finished."""
    fs, path = _filesystem(spark, root)
    if not fs.exists(path):
        return []
    done = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        marker = _filesystem(spark, f"{root}/{name}/_SUCCESS")[1]
        if name.startswith("load_") and fs.exists(marker):
            done.append(int(name.removeprefix("load_")))
    return sorted(done)


def current_path(spark: SparkSession, root: str) -> str | None:
    versions = _versions(spark, root)
    return f"{root}/load_{versions[-1]:06d}" if versions else None


def _claim(spark: SparkSession, root: str, prefix: str, after: int) -> int:
    """The next number after ``after`` that no other run has taken under ``root``."""
    number = after + 1
    while True:
        fs, path = _filesystem(spark, f"{root}/_claims/{prefix}_{number:06d}")
        if fs.createNewFile(path):
            return number
        number += 1


def truncate_load(df: DataFrame, root: str, schema: T.StructType | None = None, keep: int = 2) -> str:
    """Replace the table at ``root``: write a new folder, which then becomes current.

    A failed run leaves no success marker, so readers keep the previous load. A
    source may read the table it replaces. Runs at once write folders of their own, and the
    later number becomes current. The last ``keep`` loads stay for readers that began before.
    """
    spark = df.sparkSession
    versions = _versions(spark, root)
    path = f"{root}/load_{_claim(spark, root, 'load', versions[-1] if versions else 0):06d}"
    if schema is not None:
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    df.write.mode("overwrite").parquet(path)
    for version in _versions(spark, root)[:-keep]:
        fs, old = _filesystem(spark, f"{root}/load_{version:06d}")
        fs.delete(old, True)
    return path


def read_current(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The last complete load; an empty table if there is none."""
    path = current_path(spark, root)
    if path is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Table partitioned by a hash bucket of its key, one task per bucket range."""
    bucketed = df.withColumn("bucket", _bucket(keys, buckets))
    bucketed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def merge_bucketed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    source: DataFrame,
    keys: Sequence[str],
    buckets: int,
    update: Sequence[str] | None = None,
) -> int:
    """Upsert into a bucketed table; only the buckets the source touches are rewritten.

    The merged rows are complete in the checkpoint folder before any bucket is
    replaced, and merging the same source again gives the same table. Readers that
    must not see the swap of single buckets use ``truncate_load``. Returns the number
    of rewritten buckets.
    """
    tagged = source.withColumn("bucket", _bucket(keys, buckets))
    # At most ``buckets`` numbers come back.
    touched = sorted(r[0] for r in tagged.select("bucket").distinct().collect())
    if not touched:
        return 0
    declared = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    target = spark.read.schema(declared).parquet(path).filter(F.col("bucket").isin(touched))
    merged = cut_lineage(merge_upsert(target, tagged, [*keys, "bucket"], update))
    writer = merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    return len(touched)


def read_versions(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The table ``merge_versions`` keeps, as of its last complete merge."""
    return read_table(spark, root, schema=schema)


@dataclass(frozen=True)
class Load:
    """A full-refresh load of one source table."""

    source: str
    keep: str | None = None
    columns: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()
    casts: Mapping[str, str] = field(default_factory=dict)
    lookback: tuple[str, str] | None = None
    newest: tuple[int, str] | None = None

    def extract(self, df: DataFrame, as_of: str | None = None) -> DataFrame:
        if self.keep:
            df = df.filter(F.expr(self.keep))
        if self.lookback:
            column, interval = self.lookback
            if self.newest:
                df = extract_latest_n(df, column, as_of, self.newest[0], self.newest[1], interval)
            else:
                df = extract_lookback(df, column, as_of, interval)
        if self.columns:
            df = df.select(*self.columns)
        df = df.drop(*self.drop)
        return df.withColumns({c: F.col(c).cast(t) for c, t in self.casts.items()})


# The source tables, their filters and casts. Credential columns are
# never carried.
LOADS = {
    "area": Load("area"),
    "auxiliary_material": Load("erp_auxiliary_material"),
    "auxiliary_material_price": Load(
        "erp_auxiliary_material_price", keep="is_delete = 0", casts={"s_price_type": "int"}
    ),
    "country": Load("erp_country"),
    "material_price": Load("erp_material_price", keep="is_delete = 0 AND s_material_num IS NULL"),
    "fabric_supplier": Load("erp_fabric_supplier"),
    "fabric_supplier_contact": Load("erp_fabric_supplier_contact"),
    "fabric_supplier_transfer": Load("erp_fabric_supplier_transfer"),
    "material_price_tree": Load("erp_material_price_tree", keep="is_delete = 0"),
    "yarn_store": Load("erp_material_price_yarn_store"),
    "yarn_store_component": Load("erp_material_price_yarn_store_component"),
    "yarn_store_tree": Load("erp_material_price_yarn_store_tree"),
    "yarn_price": Load("erp_material_price_yarn_store_yarn_price"),
    "attendance_record": Load(
        "erp_oa_attendance_uer_record", lookback=("s_created_time", "1 month"), newest=(500, "dd_id")
    ),
    "punch_clock": Load(
        "erp_oa_kqj", lookback=("s_created_time", "1 month"), casts={"is_write": "smallint"}
    ),
    "review_company": Load("erp_review_company", keep="s_company_sort = '02' AND is_hidden = 0"),
    "talent_archives": Load(
        "erp_talent_archives",
        keep="s_employee_num IS NOT NULL",
        columns=(
            "s_talent_archives_id", "s_name", "s_subcompany", "s_subcompany_id", "s_depart", "s_depart_id",
            "s_talent_position", "s_talent_position_id", "s_employee_num", "s_email", "is_lead",
        ),
    ),
    "talent_position": Load("erp_talent_position"),
    "depart": Load("s_depart", keep="dd_deleted_time IS NULL"),
    "manager": Load(
        "s_manager", keep="s_activate_flag = 1", drop=("s_password",), casts={"s_lead_flag": "int"}
    ),
}


# Columns and types of targets. Those of the widest come from the source's own column list (``declared_columns``).
DECLARED = {
    "area": {
        "id": "serial", "pid": "integer", "citycode": "varchar(4)", "adcode": "varchar(6)", "name": "varchar(100)",
        "detail_name": "varchar(200)", "lng": "decimal(10,6)", "lat": "decimal(10,6)", "level": "varchar(10)",
        "initials": "varchar(2)", "pinyin": "varchar(200)",
    },
    "country": {
        "s_country_id": "serial", "s_name": "char(255)", "s_area_id": "integer", "s_country_code_id": "integer",
        "s_zh_name": "char(255)", "s_dictionary_id": "integer", "is_delete": "integer",
    },
    "yarn_store_component": {
        "s_component_id": "serial", "s_tree_id": "integer", "s_ratio": "integer", "is_delete": "integer",
        "s_created_time": "timestamp", "s_yarn_store_id": "integer",
    },
    "yarn_price": {
        "s_yarn_price_id": "serial", "s_inquiry_date": "timestamp", "s_price": "numeric(10,2)",
        "s_supplier": "varchar(255)", "s_manager_id": "integer", "s_maintenance_worker_id": "integer",
        "s_yarn_store_id": "integer", "s_create_time": "timestamp", "s_update_time": "timestamp", "is_delete": "integer",
    },
    "fabric_supplier_contact": {
        "id": "serial", "s_supplier_id": "integer", "s_contact_name": "varchar(255)", "s_contact_phone": "varchar(255)",
        "is_delete": "integer",
    },
    "fabric_supplier_transfer": {
        "s_id": "serial", "s_company_id": "integer", "s_transfer_way_name": "varchar(255)", "s_receiving_unit": "varchar(255)",
        "s_opening_bank": "varchar(255)", "s_bank_account": "varchar(255)", "is_delete": "integer",
        "s_company_name": "varchar(255)", "s_default_flag": "boolean", "s_transfer_way": "boolean",
    },
    "material_price_tree": {
        "s_tree_id": "serial", "s_tree_pid": "integer", "s_name": "varchar(255)", "s_en_name": "varchar(255)",
        "s_code": "varchar(255)", "s_remark": "varchar(255)", "s_sort": "integer", "is_delete": "integer",
    },
    "yarn_store_tree": {
        "s_tree_id": "serial", "s_tree_pid": "integer", "s_name": "varchar(255)", "s_en_name": "varchar(255)",
        "s_code": "varchar(255)", "s_remark": "varchar(255)", "s_sort": "integer", "is_delete": "integer",
        "s_tips": "varchar(255)", "created_at": "timestamp", "updated_at": "timestamp",
    },
    "yarn_store": {
        "s_yarn_store_id": "serial", "s_yarn_code": "varchar(255)", "s_yarn_type_id": "integer", "s_yarn_color_id": "integer",
        "s_green_components_id": "integer", "s_functional_materials_id": "integer", "s_yarn_functionality_id": "varchar(255)",
        "s_fiber_brand": "varchar(255)", "s_fiber_supplier": "varchar(255)", "s_remark": "varchar(255)",
        "s_filament_fiber_structure": "varchar(255)", "s_filament_staple_processing_method_id": "integer",
        "s_filament_lustre_id": "integer", "s_filament_cross_sectional_shape_id": "integer", "s_staple_special_fiber_id": "integer",
        "s_staple_yarn_quality_id": "integer", "s_staple_spinning_method_id": "integer", "s_staple_twist_id": "integer",
        "s_staple_twist_direction_id": "integer", "s_fancy_special_fiber_id": "integer", "s_fancy_yarn_name_id": "integer",
        "s_blended_special_fiber_id": "integer", "s_blended_method_id": "integer", "s_blended_yarn_count": "varchar(255)",
        "s_create_time": "timestamp", "s_update_time": "timestamp", "is_delete": "integer", "s_manager_id": "integer",
        "s_yarn_count_value": "varchar(255)", "s_yarn_count_unit_id": "integer", "s_yarn_count_unit_f": "varchar(255)",
        "s_yarn_count_count": "integer", "s_num_prefix": "varchar(255)", "s_num_suffix": "varchar(6)",
        "s_yarn_count_text": "varchar(255)",
    },
    "attendance_record": {
        "dd_id": "bigserial", "s_attendance_uer_record_id": "integer", "s_attendance_id": "integer", "s_manager_id": "integer",
        "s_open_time": "timestamp", "s_state": "smallint", "s_created_time": "timestamp", "s_updated_time": "timestamp",
        "s_deleted_time": "timestamp", "is_delete": "smallint", "s_count": "smallint", "s_type": "smallint",
        "s_attendance_wifi_mac_id": "integer", "s_classes_id": "integer", "s_affiliation_time": "timestamp", "remark": "text",
        "url": "text", "s_label_list": "text", "s_longitude": "varchar(255)", "s_latitude": "varchar(255)", "s_add": "varchar(500)",
        "s_oa_user_approval_id": "integer", "s_record_id": "integer", "s_operator_id": "integer", "reason": "varchar(500)",
    },
    "talent_archives": {
        "s_talent_archives_id": "serial", "s_name": "varchar(50)", "s_subcompany": "varchar(255)", "s_subcompany_id": "integer",
        "s_depart": "varchar(50)", "s_depart_id": "bigint", "s_talent_position": "varchar(50)", "s_talent_position_id": "integer",
        "s_employee_num": "varchar(255)", "s_email": "varchar(50)", "is_lead": "integer",
    },
    "talent_position": {
        "s_talent_position_id": "serial", "s_position": "varchar(50)", "s_en_position": "varchar(50)", "gmt_create": "timestamp",
        "gmt_modified": "timestamp", "is_delete": "smallint", "sort": "integer", "s_manager_id": "integer",
    },
    "depart": {
        "dd_id": "bigserial", "dd_create_dept_group": "varchar(20)", "dd_name": "varchar(255)", "code": "varchar(32)",
        "s_en_name": "varchar(500)", "s_jp_name": "varchar(255)", "dd_parent_id": "bigint", "dd_next_manager_id": "varchar(50)",
        "dd_created_time": "timestamp", "dd_updated_time": "timestamp", "dd_deleted_time": "timestamp",
        "dd_select_status": "char(255)", "s_lark_depart_id": "char(255)", "s_lark_parent_department_id": "char(255)",
        "sort": "int", "s_dictionary_id": "int",
    },
    "manager": {
        "s_manager_id": "serial", "s_creater": "int", "s_account": "varchar(64)", "s_account_pinyin": "varchar(255)",
        "s_account_pinyin_first": "varchar(255)", "s_cellphone": "varchar(20)", "s_email": "varchar(64)", "s_activate_flag": "int",
        "s_unionid": "varchar(255)", "s_openid": "varchar(255)", "dd_depart_ids": "text", "s_created_time": "timestamp",
        "s_updated_time": "timestamp", "s_deleted_time": "timestamp", "s_lead_flag": "smallint", "s_talent_id": "int",
        "s_mail_nickname": "varchar(255)", "s_sys_language": "varchar(10)", "s_time_zone": "int",
    },
    "punch_clock": {
        "s_id": "serial", "id": "integer", "user_id": "integer", "ext_id": "integer", "terminal_id": "varchar(255)",
        "check_type": "varchar(50)", "check_time": "timestamp", "check_data": "text", "s_created_time": "timestamp",
        "is_write": "smallint",
    },
}


def declared_columns(columns: DataFrame, name: str, credentials: Sequence[str] = ("s_password",)) -> dict[str, str]:
    """Columns and types of one table out of a database's column list, as its information schema gives it.

    ``columns`` has table_name, column_name, ordinal_position and column_type (a type with its lengths). A load's casts and dropped
    columns hold: cast columns have the cast's type, credential columns are left out. A table that is not listed fails.
    """
    load = LOADS[name]
    listed = columns.filter(F.col("table_name") == load.source).orderBy("ordinal_position")
    found = {r[0]: r[1] for r in listed.select("column_name", "column_type").collect()}  # one per column of a table
    if not found:
        raise ValueError(f"no columns listed for {load.source}")
    kept = load.columns or [c for c in found if c not in (*load.drop, *credentials)]
    absent = sorted(set(kept) - set(found))
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return {c: load.casts.get(c, found[c]) for c in kept}


def refresh(
    name: str, source: DataFrame, root: str, as_of: str | None = None, declared: Mapping[str, str] | None = None
) -> str:
    """Run the declared load ``name``: extract from ``source`` and replace ``root/name``.

    ``declared`` gives the target's columns and database types; ``DECLARED`` has those of most targets, and a wide
    table's come from the database's column list (``declared_columns``). The table is written in exactly these columns and types, and a
    source column that is missing fails the load by name. Without a declaration the extract is written as it is.
    """
    declared = DECLARED.get(name) if declared is None else declared
    extracted = LOADS[name].extract(source, as_of)
    if declared is None:
        return truncate_load(extracted, f"{root}/{name}")
    require(extracted, declared)
    schema = schema_of(dict(declared))
    return truncate_load(cast_to(extracted, schema), f"{root}/{name}", schema)
