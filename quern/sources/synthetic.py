"""A synthetic catalog and synthetic header samples over the star-schema tables, in SQL that Spark and other engines share.

They stand in for real catalogs in queries and tests: names, sizes and headers that meet every kind of rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.names import settled
from quern.functions.reference import LENGTHS

#: Rows of a table that a task gets, about.
ROWS = 100_000
TOKENS = ("_rnaseq", "_wgs_a", "_exome", ".hifi_reads", "_atac", "_chipseq", ".GRCh38", ".hg19", ".chm13", "-mc-graph", ".regions", "_targets", "")
EXTENSIONS = (".bam", ".cram", ".vcf.gz", ".g.vcf.gz", ".fastq.gz", ".fa.gz", ".bed", ".bed.gz", ".md5", ".svs", ".png", ".idat", ".h5ad", ".bw", ".txt", ".tar.gz", ".unknown", ".gfa", ".fast5.tar.gz")
INDEXES = {".bam": ".bai", ".cram": ".crai", ".vcf.gz": ".tbi", ".g.vcf.gz": ".tbi", ".bed.gz": ".csi"}


def pick(what: str, values) -> str:
    return f"CASE {what} " + " ".join(f"WHEN {i} THEN '{v}'" if isinstance(v, str) else f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


def lines(dialect: str, text: str, order: str) -> str:
    """An aggregate that joins text by line feeds."""
    return f"listagg({text}, chr(10)) WITHIN GROUP (ORDER BY {order})" if dialect == "spark" else f"string_agg({text}, chr(10) ORDER BY {order})"


_INDEX = "CASE e " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in INDEXES.items()) + " END"
CATALOG = f"""
SELECT k, concat('e', k) AS entry_id, concat('f', k) AS file_id,
       CASE WHEN m = 0 THEN concat('S', p, t, e) WHEN x IS NULL THEN concat('S', p, 'b', t, e) WHEN p % 7 = 0 THEN concat('S', p, t, x) ELSE concat('S', p, t, e, x) END AS file_name,
       CASE WHEN m = 1 AND x IS NOT NULL THEN x ELSE e END AS file_format,
       CASE WHEN k % 97 = 0 THEN 20000000000 WHEN k % 89 = 0 THEN 50000000000 WHEN k % 83 = 0 THEN 8000000000 ELSE CAST(floor(o_totalprice * 200000) AS BIGINT) END AS file_size,
       md5(concat(k, '')) AS file_md5sum, concat('drs://x/', k) AS drs_uri, concat('d', p % 13 + CASE WHEN m = 1 AND p % 11 = 0 THEN 100 ELSE 0 END) AS dataset_id,
       CASE WHEN p % 17 = 0 THEN 'ANVIL_1000G_PRIMED_data_model' ELSE concat('Study ', p % 13) END AS dataset_title, p % 5 = 0 AS is_supplementary,
       CASE WHEN p % 3 = 0 THEN 'genomic' WHEN p % 3 = 1 THEN 'transcriptomic' END AS data_modality, CASE WHEN p % 4 = 0 THEN 'hg38' WHEN p % 4 = 1 THEN 'GRCh37' END AS reference_assembly
FROM (SELECT *, {_INDEX} AS x FROM (
  SELECT o_orderkey AS k, o_orderkey % 2 AS m, p, o_totalprice, {pick('p % 13', TOKENS)} AS t, {pick('p % 19', EXTENSIONS)} AS e
  FROM (SELECT *, CAST(floor(o_orderkey / 2.0) AS BIGINT) AS p FROM orders) a) b) c
"""

_LENGTH = "CASE l_orderkey % 4 " + " ".join(f"WHEN {i} THEN {pick('l_linenumber - 1', v[:7])} + CAST((l_quantity - 25) * 50 AS BIGINT)" for i, v in enumerate(LENGTHS.values())) + " ELSE 1000 + l_linenumber END"
PLATFORMS = ("ILLUMINA", "PACBIO", "ONT", "nanopore", "unknown")
PROGRAMS = ("STAR", "bwa", "minimap2", "isoseq", "lima", "salmon", "other")
CALLERS = ("HaplotypeCaller", "DeepVariant", "strelka2", "Mutect2", "manta", "bcftools call", "none", "sniffles")
REFERENCES = ("GRCh38.fa", "hg19.fa", "chm13.fa", "GCA_000001405.14", "GCA_000001405.28", "other.fa")


def sam_headers(dialect: str) -> str:
    """k, header_text."""
    sq = lines(dialect, "concat('@SQ', chr(9), 'SN:chr', l_linenumber, chr(9), 'LN:', n)", "l_linenumber")
    return f"""
SELECT l_orderkey AS k, concat('@HD', chr(9), 'VN:1.6', chr(10), CASE WHEN l_orderkey % 10 = 9 THEN '' ELSE concat({sq}, chr(10)) END,
       '@RG', chr(9), 'ID:r', chr(9), 'PL:', {pick('l_orderkey % 5', PLATFORMS)}, chr(10), '@PG', chr(9), 'ID:p', chr(9), 'PN:', {pick('l_orderkey % 7', PROGRAMS)}) AS header_text
FROM (SELECT *, {_LENGTH} AS n FROM lineitem) a GROUP BY l_orderkey"""


def vcf_headers(dialect: str) -> str:
    """k, header_text."""
    contigs = lines(dialect, "concat('##contig=<ID=chr', l_linenumber, ',length=', n, '>')", "l_linenumber")
    return f"""
SELECT l_orderkey AS k, concat('##fileformat=VCFv4.2', chr(10), '##source=', {pick('l_orderkey % 8', CALLERS)}, chr(10), '##reference=file:///', {pick('l_orderkey % 6', REFERENCES)}, chr(10), {contigs},
       CASE WHEN l_orderkey % 9 = 0 THEN concat(chr(10), '##INFO=<ID=SVTYPE,Number=1,Type=String,Description="a, b">') WHEN l_orderkey % 9 = 1 THEN concat(chr(10), '##INFO=<ID=SOMATIC,Number=0>') ELSE '' END) AS header_text
FROM (SELECT *, {_LENGTH} AS n FROM lineitem) a GROUP BY l_orderkey"""


_READS = (
    "concat('@A00297:44:HFKH3DSXX:2:1354:', l_linenumber, ':1000 1:N:0:ACGT')",
    "concat('@HWI-ST:3:', l_linenumber, ':10:20#ACG/1')",
    "concat('@ERR3242571.', l_linenumber, ' A00297:44:HFKH3DSXX:2:1354:30508:28870/1')",
    "concat('@SRR10.', l_linenumber, ' x')",
    "concat('@m64011_190830_220126/', l_linenumber, '/ccs')",
    "concat('@m84010_1_2/', l_linenumber, '/0_100')",
    "concat('@0a1b2c3d-0000-1111-2222-00000000000', l_linenumber, ' runid=abc ch=', l_linenumber)",
    "concat('@V30001234', l_linenumber, 'L1C001R0010000', l_linenumber, '/2')",
    "concat('@read', l_linenumber)",
    "concat('@DRR77.', l_linenumber, ' m54001_1_2/', l_linenumber, '/ccs')",
)


def read_names(dialect: str) -> str:
    """k, reads: read names, a line each."""
    case = "CASE l_orderkey % 10 " + " ".join(f"WHEN {i} THEN {r}" for i, r in enumerate(_READS)) + " END"
    return f"SELECT l_orderkey AS k, {lines(dialect, 'r', 'l_linenumber')} AS reads FROM (SELECT *, {case} AS r FROM lineitem) a GROUP BY l_orderkey"


def contig_names(dialect: str) -> str:
    """k, contigs: sequence names, a line each."""
    name = "CASE c_custkey % 6 WHEN 0 THEN concat('chr', n_nationkey) WHEN 1 THEN concat('h1tg', n_nationkey, 'l') WHEN 2 THEN concat('ENST000', n_nationkey) WHEN 3 THEN concat('u', n_nationkey, '_', r_regionkey) WHEN 4 THEN concat('z', n_nationkey) ELSE CASE WHEN n_nationkey < 5 THEN concat('', n_nationkey) ELSE concat('scaffold_', n_nationkey) END END"
    return f"""
SELECT c_custkey AS k, {lines(dialect, 's', 'n_nationkey, r_regionkey')} AS contigs
FROM (SELECT c_custkey, n_nationkey, r_regionkey, {name} AS s FROM customer
      LATERAL VIEW explode(sequence(0, 24)) n AS n_nationkey LATERAL VIEW explode(sequence(0, CASE WHEN c_custkey % 6 = 3 THEN 4 ELSE 0 END)) r AS r_regionkey) a GROUP BY c_custkey"""


def member_names(dialect: str) -> str:
    """k, members: archive members, a line each."""
    name = "CASE CASE WHEN l_orderkey % 5 = 0 THEN l_partkey % 7 ELSE l_partkey % 5 END WHEN 0 THEN concat('d/a', l_linenumber, '.bam') WHEN 1 THEN concat('d.x/b', l_linenumber, '.vcf.gz') WHEN 2 THEN concat('c', l_linenumber, '.fasta') WHEN 3 THEN concat('r', l_linenumber, '.fq.gz') WHEN 4 THEN 'notes' WHEN 5 THEN 'w/PL_var.tdb/__array_schema.tdb' ELSE 'w/genes.tdb' END"
    return f"SELECT l_orderkey AS k, {lines(dialect, 's', 'l_linenumber, s')} AS members FROM (SELECT *, {name} AS s FROM lineitem) a GROUP BY l_orderkey"


#: k, chrom, coord: BED rows. Names without chr, non-standard names, and coordinates past some assemblies' ends.
BED = """
SELECT l_orderkey AS k, CASE l_orderkey % 5 WHEN 0 THEN concat('chr', l_linenumber) WHEN 1 THEN concat('', l_linenumber) WHEN 2 THEN concat('h1tg', l_linenumber) WHEN 3 THEN concat('CHR', l_linenumber) ELSE 'chr1' END AS chrom,
       CASE WHEN l_orderkey % 5 = 4 AND l_orderkey % 3 = 0 THEN 249000000 WHEN l_orderkey % 5 = 4 AND l_orderkey % 3 = 1 THEN 248600000 WHEN l_orderkey % 15 = 3 THEN 999999999 ELSE CAST(l_extendedprice AS BIGINT) END AS coord
FROM lineitem
"""


def over(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    """A Spark SQL text over some of the tables.

    Rules cost far more than reading, and splits follow a table's bytes, of which it has few a row: a table is dealt out by its
    first column, its key, to all cores and so that a task gets some ROWS rows. Grouping by the key needs no other shuffle then.
    """
    cores = spark.sparkContext.defaultParallelism
    for t in tables:
        df = spark.read.parquet(f"{sf_dir}/{t}.parquet")
        df.repartition(max(cores, -(-df.count() // ROWS)), df.columns[0]).createOrReplaceTempView(t)
    return spark.sql(sql)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = over(spark, sf_dir, CATALOG, "orders")
    return settled(files, {c: F.col(c) for c in files.columns[3:]}).select(files.columns)
