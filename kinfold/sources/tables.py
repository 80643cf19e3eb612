"""Headerless tab-separated tables, line lists, synonym, cluster and family files; keyed and partitioned sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The columns of each file kind.
SCHEMAS = {
    "assignments": "id string, function string",
    "function_index": "idx int, function string",
    "local_defs": "fam int, function string, subfam string, mean double, sd double, gene string, size int",
    "local_members": "fam int, id string, len int, z double, gene string",
    "global_families": "gfam string, n_lfams int, n_genera int, id string, len int, function string, lfam int, genus string, lfam2 int",
    "pegmap": "rep string, genus string, fam int, func_idx long, function string, genome string",
    "signatures": "kmer string, otu int, avg_from_end int, function_index int, weight double, mean int, median int, var int, n_proteins int",
    "raw_kmers": "kmer string, from_end int, function_index int, weight double, otu int",
    "ani": "query string, ref string, ani double, frag_maps int, frags int",
    "distances": "id1 string, id2 string, n_common long, score double",
    "max_ids": "scope string, max_id long",
}


def read_tsv(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", quote="", schema=SCHEMAS.get(kind, kind))


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.csv(path, sep="\t", quote="", emptyValue="")


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """The distinct lines (value) of list files."""
    return spark.read.text(list(paths)).where("value <> ''").distinct()


def read_assignments(spark: SparkSession, path: str) -> DataFrame:
    """(id, function): lines without a tab are skipped, a third column is ignored, fragments are skipped, the last line of an id wins.

    The order of lines is that of file name and place in the file.
    """
    from kinfold.functions.annotations import is_truncated

    lines = spark.read.text(path).where(F.col("value").contains("\t")).select("value", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("n"))
    parts = F.split("value", "\t")
    rows = lines.select(parts[0].alias("id"), parts[1].alias("function"), "file", "n").where(~is_truncated(F.col("function")))
    return rows.groupBy("id").agg(F.max_by("function", F.struct("file", "n")).alias("function"))


def read_synonyms(spark: SparkSession, path: str) -> DataFrame:
    """(md5, len, id, id_len) of lines `gnl|md5|H,len <tab> id,len;id,len`; other lines are left out."""
    form = r"^gnl\|md5\|([0-9a-f]+),(\d+)\t(.+)$"
    ok = spark.read.text(path).where(F.col("value").rlike(form))
    at = ok.select(F.regexp_extract("value", form, 1).alias("md5"), F.regexp_extract("value", form, 2).cast("int").alias("len"), F.explode(F.split(F.regexp_extract("value", form, 3), ";")).alias("x"))
    return at.select("md5", "len", F.regexp_extract("x", r"^(.*),(\d+)$", 1).alias("id"), F.regexp_extract("x", r"^(.*),(\d+)$", 2).cast("int").alias("id_len"))


def write_synonyms(groups: DataFrame, path: str) -> None:
    """Synonym lines of (md5, members: array of (id, len)); the first member's length stands for the group."""
    each = F.array_join(F.transform("members", lambda m: F.concat_ws(",", m["id"], m["len"].cast("string"))), ";")
    groups.select(F.concat(F.lit("gnl|md5|"), "md5", F.lit(","), F.col("members")[0]["len"].cast("string"), F.lit("\t"), each)).write.text(path)


def list_files(spark: SparkSession, *folders: str) -> DataFrame:
    """(path, length) of the regular files that lie in the folders themselves."""
    return spark.read.format("binaryFile").load(list(folders)).select("path", "length")


def read_families(spark: SparkSession, path: str) -> DataFrame:
    """(fam, id, function, lfam, genus) of a release's global families."""
    return read_tsv(spark, path, "global_families").select(F.col("gfam").alias("fam"), "id", "function", "lfam", "genus")


def read_pegmap(spark: SparkSession, path: str) -> DataFrame:
    """Rows by representative; of several lines of one the last wins (by file name and place in the file)."""
    rows = read_tsv(spark, path, "pegmap").withColumn("_at", F.struct(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("n")))
    rest = [c for c in rows.columns if c not in ("rep", "_at")]
    return rows.groupBy("rep").agg(F.max_by(F.struct(*rest), "_at").alias("_x")).select("rep", "_x.*")


def genus_tables(seqs: DataFrame) -> dict[str, DataFrame]:
    """What a genus folder holds, from sequences (genome, id, def, seq): sequences, lengths, genomes, names and checksum groups."""
    from kinfold.functions.annotations import definition
    from kinfold.operators.nr import groups, keep_good

    return {
        "seqs": seqs.select("genome", "id", "seq"),
        "seq_len": seqs.select("id", F.length("seq").alias("len")),
        "genomes": seqs.select("genome").distinct(),
        "names": seqs.select("id", definition(F.col("def"))["function"].alias("function")).where("function is not null"),
        "nr": groups(keep_good(seqs.select("id", "seq"))),
    }


def read_ragged(spark: SparkSession, path: str) -> DataFrame:
    """(cluster, pos, member) of lines whose members are parted by tabs."""
    rows = spark.read.text(path).where("value <> ''").select(F.xxhash64(F.input_file_name(), F.monotonically_increasing_id()).alias("cluster"), F.split("value", "\t").alias("m"))
    return rows.select("cluster", F.posexplode("m").alias("pos", "member"))


def read_features(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(features, contigs) of a headered feature table, columns found by name: coding features with the length of their contig."""
    rows = spark.read.csv(path, sep="\t", header=True, quote="")
    contigs = rows.where("feature_type = 'source'").select("accession", F.col("na_length").cast("int").alias("contig_len"))
    cds = rows.where("feature_type = 'CDS'").select("patric_id", "accession", "gene", "strand", "product", F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"))
    return cds.join(contigs, "accession", "left"), contigs


def write_keyed(df: DataFrame, path: str, *keys: str) -> None:
    """A table with a folder for each value of the keys: what a keyed store is looked up for is then a pruned read."""
    df.repartition(*keys).write.partitionBy(*keys).mode("overwrite").parquet(path)


def point_lookup(spark: SparkSession, path: str, **keys) -> DataFrame:
    df = spark.read.parquet(path)
    for k, v in keys.items():
        df = df.where(F.col(k) == v)
    return df


def replace_partition(df: DataFrame, path: str, key: str) -> None:
    """Writes the values of `key` that df holds, leaving all others as they are."""
    df.write.option("partitionOverwriteMode", "dynamic").partitionBy(key).mode("overwrite").parquet(path)


def upsert(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """table with the rows of changes in place of those of the same key (of several changes the one of the greatest `seq`)."""
    last = changes.groupBy(key).agg(F.max_by(F.struct(*[c for c in changes.columns if c != key]), "seq").alias("x")).select(key, "x.*").drop("seq")
    return table.join(last.select(key), key, "left_anti").unionByName(last, allowMissingColumns=True)


def genus_index(genomes: DataFrame) -> DataFrame:
    """(idx, genus, n) of genera by genome count, from 1."""
    n = genomes.groupBy("genus").agg(F.countDistinct("genome").alias("n"))
    return n.withColumn("idx", F.row_number().over(Window.orderBy(F.col("n").desc(), "genus")))
