"""Read files: listing, pairing, reads, and the guess of the chemistry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.readers import numbered_lines

# File pattern, mate pattern, barcode length, least read length of the long layout,
# overlap below which a guess is doubtful.
FASTQ_PATTERN = r".+\.fastq\.gz$"
MATE_PATTERN = r"(_|\.)(R[12])"
BARCODE_LENGTH = 16
LONG_R1 = 28
LOW_OVERLAP = 0.7

# Chemistries, the whitelist family each belongs to.
CHEMISTRY_FAMILIES = {
    "3LT": "3LT", "3v2": "3v2_5v1_5v2", "3v3": "3v3", "3v4": "3v4", "5v1": "3v2_5v1_5v2", "5v2": "3v2_5v1_5v2", "5v3": "5v3",
    "multiome": "multiome",
}


def list_fastqs(spark: SparkSession, path: str) -> DataFrame:
    """Read files under a folder with their size in GB; contents are not read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    return f.where(F.col("path").rlike(FASTQ_PATTERN)).select(
        "path", F.element_at(F.split("path", "/"), -1).alias("file"), (F.col("length") / F.lit(1e9)).alias("size_gb"))


def pair_fastqs(files: DataFrame, runs: DataFrame, run: str = "run_id") -> DataFrame:
    """R1 and R2 files per run, whether the two sides agree, and the size of R1; unmatched files drop out.

    A run name is looked up among the prefixes-by-offset of its mate part: the text before the mate
    tag is cut into its substrings of the run names' lengths, so the match is an equi join.
    """
    mate = files.select("file", "size_gb", F.regexp_extract("file", MATE_PATTERN, 2).alias("mate"), F.regexp_replace("file", MATE_PATTERN, "$1R").alias("stem"),
                        F.split("file", MATE_PATTERN).getItem(0).alias("_head")).where("mate <> ''")
    lens = runs.select(F.length(run).alias("l")).distinct().agg(F.collect_set("l").alias("ls")).scalar()
    cut = F.flatten(F.transform(F.col("_ls"), lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length("_head") - n + 1, F.lit(1))), lambda i: F.substring(F.col("_head"), i, n))))
    keyed = mate.withColumn("_ls", lens).select("file", "size_gb", "mate", "stem", F.explode(F.array_distinct(cut)).alias(run))
    hit = keyed.join(runs.select(run).distinct(), run)
    r1, r2 = F.col("mate") == "R1", F.col("mate") == "R2"
    out = hit.groupBy(run).agg(
        F.array_sort(F.collect_set(F.when(r1, F.col("file")))).alias("r1_files"), F.array_sort(F.collect_set(F.when(r2, F.col("file")))).alias("r2_files"),
        F.collect_set(F.when(r1, F.col("stem"))).alias("_a"), F.collect_set(F.when(r2, F.col("stem"))).alias("_b"), F.sum(F.when(r1, F.col("size_gb")).otherwise(0.0)).alias("r1_gb"))
    same = (F.size(F.array_except("_a", "_b")) == 0) & (F.size(F.array_except("_b", "_a")) == 0)
    return out.withColumn("mates_agree", same).drop("_a", "_b")


def fastq_reads(spark: SparkSession, path: str, n: int | None = None) -> DataFrame:
    """Reads of FASTQ files: file, read_no, sequence, barcode (first 16 bases), read_length.

    A record is four lines; its second line is the sequence. ``n`` keeps the first reads of a file.
    """
    seq = numbered_lines(spark, path).where(F.col("line_no") % 4 == 1)
    out = seq.select("file", (F.floor(F.col("line_no") / 4) + 1).alias("read_no"), F.col("value").alias("sequence"),
                     F.substring("value", 1, BARCODE_LENGTH).alias("barcode"), F.length("value").alias("read_length"))
    return out.where(F.col("read_no") <= n) if n is not None else out


def pick_file(files: DataFrame, seed: int = 1234) -> DataFrame:
    """One file by a seeded hash of its name."""
    return files.orderBy(F.xxhash64("file", F.lit(seed)), "file").limit(1)


def whitelist_overlap(barcodes: DataFrame, whitelists: DataFrame) -> DataFrame:
    """Share of distinct read barcodes found in each whitelist, per chemistry."""
    b = barcodes.select("barcode").distinct()
    n = b.agg(F.count(F.lit(1)).alias("n")).scalar()
    lists = whitelists.select("gex_barcodes_f", "barcode").distinct()
    hits = lists.join(b, "barcode", "left_semi").groupBy("gex_barcodes_f").agg(F.count(F.lit(1)).alias("m"))
    names = whitelists.select("chemistry", "gex_barcodes_f").distinct()
    return names.join(hits, "gex_barcodes_f", "left").withColumn("_n", n).select(
        "chemistry", "gex_barcodes_f", F.when(F.col("_n") > 0, F.coalesce("m", F.lit(0)) / F.when(F.col("_n") > 0, F.col("_n"))).otherwise(0.0).alias("overlap"))


def detect_chemistry(overlaps: DataFrame, r1_length: int, cells_fw: int, cells_rc: int) -> DataFrame:
    """Chemistry from the best whitelist, the R1 length and the cells counted in both orientations.

    One row: whitelist, overlap, low_overlap, layout, orientation, sample_chemistry. Equal counts in
    both orientations raise when the whitelist leaves the choice open.
    """
    top = overlaps.agg(F.max("overlap").alias("m")).scalar()
    best = overlaps.withColumn("_m", top).where(F.col("overlap") == F.col("_m"))
    g = best.agg(F.min("gex_barcodes_f").alias("gex_barcodes_f"), F.max("overlap").alias("overlap"), F.array_sort(F.collect_set("chemistry")).alias("c"))
    one = F.size("c") == 1
    old = F.col("c") == F.array(F.lit("3v2"), F.lit("5v1"), F.lit("5v2"))
    if cells_fw == cells_rc:
        guess = F.raise_error(F.lit("ambiguous orientation: same number of cells in both directions")).cast("string")
    else:
        guess = F.lit("fw" if cells_fw > cells_rc else "rc")
    ori = F.when(one & (F.element_at("c", 1) == "5v3"), "rc").when(one, "fw").otherwise(guess)
    g = g.withColumn("orientation", ori)
    short = (~old) & (F.lit(r1_length) < LONG_R1)
    fw = F.col("orientation") == "fw"
    chem = F.when(old | short, F.when(fw, "3v2").otherwise("5v1/5v2")).when(one, F.element_at("c", 1)).otherwise(F.when(fw, "3v3").otherwise("5v3"))
    return g.select("gex_barcodes_f", "overlap", (F.col("overlap") < LOW_OVERLAP).alias("low_overlap"),
                    F.when(old | short, "10xv2").otherwise("10xv3").alias("layout"), "orientation", chem.alias("sample_chemistry"))
