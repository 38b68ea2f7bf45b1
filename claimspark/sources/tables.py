"""Table sources and sinks."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from claimspark.schemas import schema
from claimspark.sources.files import Folder, Log

ITEM = "cd_item_ressarciment_sus_anexo"
BAD_LINE = "linha_invalida"


def read_table(spark: SparkSession, base: str, name: str, ddl: str | None = None) -> DataFrame:
    """Scan one stored table with an explicit schema, so nothing is inferred."""
    wanted = StructType.fromDDL(ddl) if ddl else schema(name)
    return spark.read.schema(wanted).parquet(f"{base}/{name}.parquet")


def config(df: DataFrame, cfg: DataFrame, key: str, default: str | None = None, tenant: str = "cd_multi_empresa",
           out: str | None = None) -> DataFrame:
    """Add the value of ``key`` for the row's tenant, else ``default``.

    The key filter reaches the scan; one value per tenant is left, so the join
    never multiplies rows and is broadcast whenever it is small.
    """
    out = out or key.lower()
    values = (
        cfg.filter((F.col("chave") == key) & F.col("valor").isNotNull())
        .groupBy(F.col("cd_multi_empresa").alias("_cfg_tenant"))
        .agg(F.min("valor").alias("_cfg_value"))
    )
    value = F.coalesce("_cfg_value", F.lit(default)) if default is not None else F.col("_cfg_value")
    return (
        df.join(values, F.col(tenant) == F.col("_cfg_tenant"), "left")
        .withColumn(out, value)
        .drop("_cfg_tenant", "_cfg_value")
    )


def gate(df: DataFrame, cfg: DataFrame, key: str, value: str, tenant: str = "cd_multi_empresa") -> DataFrame:
    """Rows whose tenant has ``key`` set to ``value``."""
    open_for = cfg.filter((F.col("chave") == key) & (F.col("valor") == value)).select(
        F.col("cd_multi_empresa").alias("_gate_tenant")
    )
    return df.join(open_for, F.col(tenant) == F.col("_gate_tenant"), "left_semi")


def append(df: DataFrame, path: str, batch: str) -> None:
    """Add the rows of one batch to a result table.

    The table is laid out by batch and a rerun of the same batch replaces only its
    own folder, so a retried job does not add rows twice, nor keep rows it no longer has.
    """
    if not re.fullmatch(r"[\w.-]+", batch, re.ASCII):
        raise ValueError("a batch is named by letters, digits, dots and dashes")
    df.write.mode("overwrite").parquet(f"{path}/id_lote_carga={batch}")


def update_by_key(target: DataFrame, changes: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """``target`` with ``cols`` replaced where ``changes`` has the key.

    ``changes`` must hold one row per key. A NULL in it is written as NULL.
    """
    renamed = changes.select(*keys, F.lit(True).alias("_matched"), *[F.col(c).alias(f"_new_{c}") for c in cols])
    merged = target.join(renamed, keys, "left")
    return merged.select(
        *[F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in target.columns]
    )


def consume_staging(spark: SparkSession, staging: str, path: str) -> DataFrame:
    """Take the rows stored under ``staging`` over into ``path`` and drop the files that held them.

    The files are listed once. Their rows are written as a generation of their own, which counts from the
    moment its entry, with the list, is in the log of ``path``; then just these files are dropped. Rows that arrive
    meanwhile are in other files and wait for the next call. A job that stops before the entry
    leaves everything as it was; one that stops after it leaves files that the next call drops without
    taking them again. Returns what a read of the staging table gives afterwards.
    """
    place, log = Folder(spark, staging), Log(spark, f"{path}/_generations")
    while True:
        number, _ = log.last()
        taken = {name for entry in log.entries() for name in entry["files"]}
        found = place.names()
        names = [n for n in found if n not in taken]
        generation = f"generation-{uuid.uuid4().hex}"
        try:
            schema = spark.read.parquet(staging).schema
            if names:
                spark.read.schema(schema).parquet(*(f"{staging}/{n}" for n in names)).write.parquet(f"{path}/{generation}")
            done = not names or log.add(number + 1, {"files": names, "rows": generation})
        except Exception:
            if log.last()[0] == number and place.names() == found:
                raise
            done = False  # the files went while they were read
        if done:
            break
        Folder(spark, f"{path}/{generation}").delete()  # another job took the rows
    # an empty file keeps the schema where a read finds it; it is moved in, as two writes into one folder disturb each other
    spark.createDataFrame([], schema).coalesce(1).write.parquet(f"{staging}/.{generation}")
    for name in place.names(f".{generation}"):
        place.move(f".{generation}/{name}", name)
    place.delete(f".{generation}")
    for name in found:
        place.delete(name)
    return spark.read.schema(schema).parquet(staging)


def taken_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all generations that ``consume_staging`` took over."""
    named = [f"{path}/{entry['rows']}" for entry in Log(spark, f"{path}/_generations").entries()]
    return spark.read.schema(schema).parquet(*named) if named else spark.createDataFrame([], schema)


def import_items(spark: SparkSession, path: str, notice_id: int | None = None, sep: str = ";") -> DataFrame:
    """Read a return file (delimited text with a header line) into item rows.

    Lines that do not fit the item layout keep their text in ``linha_invalida``.
    """
    layout = StructType(schema("item").fields).add(BAD_LINE, "string")
    rows = (
        spark.read.schema(layout)
        .option("header", True)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_LINE)
        .option("enforceSchema", True)
        .csv(path)
    )
    if notice_id is not None:
        rows = rows.withColumn("cd_ressarcimento_sus", F.lit(notice_id).cast("bigint"))
    return rows


def export_items(items: DataFrame, path: str, sep: str = ";") -> None:
    """Write item rows in the layout that ``import_items`` reads."""
    items.select(*schema("item").fieldNames()).write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def impugned(items: DataFrame, validations: DataFrame) -> DataFrame:
    """Disputed validations with their item."""
    disputed = validations.filter(F.col("tp_validacao") == "I").select(
        "cd_valida_item_ress_sus_anexo", ITEM, "ds_mensagem"
    )
    return items.select(
        ITEM, "cd_ressarcimento_sus", "nr_atendimento", "cd_cco", "cd_procedimento", "vl_procedimento"
    ).join(disputed, ITEM)


def export_impugned(items: DataFrame, validations: DataFrame, path: str, sep: str = ";") -> None:
    """Write the disputed items as delimited text, one file per task."""
    impugned(items, validations).write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
