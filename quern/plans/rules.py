"""The rule set: which claims a file's extension, name, dataset and header support.

A rule fires when all of its conditions hold; then it claims a value or a status for each field that it names. Patterns are
searched without regard to case. Rules are applied by tier, in this order within a tier.
"""

from __future__ import annotations

from typing import NamedTuple

FIELDS = ("data_modality", "data_type", "assay_type", "reference_assembly", "platform")
CLASSIFIED, NOT_APPLICABLE, NOT_CLASSIFIED = "classified", "not_applicable", "not_classified"
CONTENT_TIER = 4


class Rule(NamedTuple):
    id: str
    tier: int
    scope: str
    when: dict
    then: dict
    status: dict


CONDITIONS = {
    "always", "extensions", "format", "filename_pattern", "dataset_pattern", "file_format", "file_size_min_gb", "file_size_max_gb", "platform",
    "modality_not_set", "reference_not_set", "header_section", "header_field", "header_pattern", "header_absent", "vcf_header_type", "vcf_pattern", "fastq_pattern",
}
SCOPES = {"extension", "filename", "file_size", "header", "vcf_header", "fastq_header"}

# The closed vocabularies of the five fields.
VOCABULARY = {
    "data_modality": ("genomic", "transcriptomic.bulk", "transcriptomic.single_cell", "epigenomic.chromatin_accessibility", "epigenomic.histone_modification", "epigenomic.methylation", "imaging.histology"),
    "data_type": ("alignments", "reads", "sequence", "assembly", "assembly.reference", "variants", "variants.germline", "variants.somatic", "variants.structural", "variants.cnv", "genotypes", "annotations", "peaks", "signal", "raw_signal", "array_signal", "images", "expression_matrix", "quantification", "pangenome", "pangenome.reference", "index", "checksum", "statistics", "log", "interval_set"),
    "reference_assembly": ("GRCh37", "GRCh38", "CHM13"),
    "assay_type": ("WGS", "WES", "RNA-seq", "ATAC-seq", "ChIP-seq", "Bisulfite-seq", "Methylation array", "Histology"),
    "platform": ("ILLUMINA", "PACBIO", "ONT", "MGI", "ELEMENT", "ULTIMA"),
}

# The rules, with their ids as they appear in evidence.
RULES = [
    Rule("index_not_applicable", 1, "extension", {"extensions": (".bai", ".crai", ".tbi", ".csi", ".fai", ".idx", ".pbi")}, {}, {"data_modality": "not_applicable", "data_type": "not_applicable", "assay_type": "not_applicable", "platform": "not_applicable"}),
    Rule("checksum_not_applicable", 2, "extension", {"extensions": (".md5",)}, {}, {"data_modality": "not_applicable", "data_type": "not_applicable", "reference_assembly": "not_applicable", "assay_type": "not_applicable", "platform": "not_applicable"}),
    Rule("log_not_applicable", 2, "extension", {"extensions": (".log",)}, {}, {"data_modality": "not_applicable", "data_type": "not_applicable", "reference_assembly": "not_applicable", "assay_type": "not_applicable", "platform": "not_applicable"}),
    Rule("chunked_upload_not_applicable", 2, "filename", {"filename_pattern": r"gs-chunked-io-part\.\d+"}, {}, {"data_modality": "not_applicable", "data_type": "not_applicable", "reference_assembly": "not_applicable", "assay_type": "not_applicable", "platform": "not_applicable"}),
    Rule("timestamp_not_applicable", 2, "filename", {"filename_pattern": r"^\d{4}-\d{2}-\d{2}T\d{6}\.\d+Z$"}, {}, {"data_modality": "not_applicable", "data_type": "not_applicable", "reference_assembly": "not_applicable", "assay_type": "not_applicable", "platform": "not_applicable"}),
    Rule("variant_default_genomic", 1, "extension", {"extensions": (".vcf", ".bcf", ".gvcf", ".g.vcf")}, {"data_modality": "genomic", "data_type": "variants"}, {}),
    Rule("plink_genomic", 1, "extension", {"extensions": (".pgen", ".pvar", ".psam")}, {"data_modality": "genomic", "data_type": "genotypes"}, {}),
    Rule("idat_methylation", 1, "extension", {"extensions": (".idat",)}, {"data_modality": "epigenomic.methylation", "data_type": "array_signal", "assay_type": "Methylation array"}, {}),
    Rule("sc_matrix_default", 1, "extension", {"extensions": (".h5ad", ".loom", ".mtx")}, {"data_modality": "transcriptomic.single_cell", "data_type": "expression_matrix"}, {}),
    Rule("image_svs_histology", 2, "extension", {"extensions": (".svs",)}, {"data_modality": "imaging.histology", "data_type": "images", "assay_type": "Histology"}, {"platform": "not_applicable", "reference_assembly": "not_applicable"}),
    Rule("image_derived", 2, "extension", {"extensions": (".png", ".jpg", ".tiff", ".tif")}, {"data_type": "images"}, {"data_modality": "not_applicable", "platform": "not_applicable", "reference_assembly": "not_applicable", "assay_type": "not_applicable"}),
    Rule("nanopore_fast5", 2, "extension", {"extensions": (".fast5",)}, {"data_type": "raw_signal", "platform": "ONT"}, {"reference_assembly": "not_applicable"}),
    Rule("nanopore_pod5", 2, "extension", {"extensions": (".pod5",)}, {"data_type": "raw_signal", "platform": "ONT"}, {"reference_assembly": "not_applicable"}),
    Rule("reads_base", 2, "extension", {"extensions": (".fastq", ".fq")}, {"data_type": "reads"}, {"reference_assembly": "not_applicable"}),
    Rule("fasta_base", 1, "extension", {"format": "FASTA"}, {"data_type": "sequence"}, {"platform": "not_applicable", "assay_type": "not_applicable"}),
    Rule("pangenome_graph", 1, "extension", {"extensions": (".gfa", ".rgfa", ".gbz", ".vg", ".gbwt", ".xg")}, {"data_modality": "genomic", "data_type": "pangenome"}, {"platform": "not_applicable", "assay_type": "not_applicable"}),
    Rule("alignment_rnaseq_filename", 2, "filename", {"extensions": (".bam", ".cram", ".sam"), "filename_pattern": r"(?i)_rna_|rnaseq|rna-seq|transcriptome|_RNA\."}, {"data_modality": "transcriptomic.bulk", "data_type": "alignments"}, {}),
    Rule("alignment_isoseq_filename", 2, "filename", {"extensions": (".bam", ".cram"), "filename_pattern": r"(?i)\.flnc\.|isoseq|iso-seq"}, {"data_modality": "transcriptomic.bulk", "data_type": "alignments"}, {}),
    Rule("alignment_scrna_filename", 2, "filename", {"extensions": (".bam", ".cram", ".sam"), "filename_pattern": "(?i)scrna|sc_rna|single.?cell|10x|chromium"}, {"data_modality": "transcriptomic.single_cell", "data_type": "alignments"}, {}),
    Rule("alignment_atac_filename", 2, "filename", {"extensions": (".bam", ".cram", ".sam"), "filename_pattern": "(?i)atac|_ATAC_"}, {"data_modality": "epigenomic.chromatin_accessibility", "data_type": "alignments", "assay_type": "ATAC-seq"}, {}),
    Rule("alignment_chip_filename", 2, "filename", {"extensions": (".bam", ".cram", ".sam"), "filename_pattern": "(?i)chip|_ChIP_|chipseq"}, {"data_modality": "epigenomic.histone_modification", "data_type": "alignments", "assay_type": "ChIP-seq"}, {}),
    Rule("alignment_wgs_filename", 2, "filename", {"extensions": (".bam", ".cram", ".sam"), "filename_pattern": r"(?i)_wgs_|_WGS\.|whole.?genome"}, {"data_modality": "genomic", "data_type": "alignments", "assay_type": "WGS"}, {}),
    Rule("alignment_wes_filename", 2, "filename", {"extensions": (".bam", ".cram", ".sam"), "filename_pattern": r"(?i)_wes_|exome|_WES\."}, {"data_modality": "genomic", "data_type": "alignments", "assay_type": "WES"}, {}),
    Rule("alignment_hifi_filename", 2, "filename", {"extensions": (".bam", ".cram", ".sam"), "filename_pattern": r"(?i)hifi|\.hifi_reads\.|pacbio|_pb_"}, {"data_modality": "genomic", "data_type": "alignments", "assay_type": "WGS", "platform": "PACBIO"}, {}),
    Rule("alignment_star_aligner", 2, "filename", {"extensions": (".bam", ".cram", ".sam"), "filename_pattern": r"(?i)Aligned\.sortedByCoord|_STAR_|\.star\."}, {"data_modality": "transcriptomic.bulk", "data_type": "alignments", "assay_type": "RNA-seq"}, {}),
    Rule("pangenome_reference_mc", 2, "filename", {"extensions": (".gfa", ".rgfa", ".gbz", ".vg", ".gbwt", ".xg"), "filename_pattern": "(?i)-mc-"}, {"data_modality": "genomic", "data_type": "pangenome.reference"}, {}),
    Rule("filename_ref_grch38", 2, "filename", {"filename_pattern": "(?i)hg38|grch38|hs38"}, {"reference_assembly": "GRCh38"}, {}),
    Rule("filename_ref_grch37", 2, "filename", {"filename_pattern": "(?i)hg19|grch37|hs37|b37"}, {"reference_assembly": "GRCh37"}, {}),
    Rule("filename_ref_chm13", 2, "filename", {"filename_pattern": "(?i)chm13|t2t|CHM13v2|hs1"}, {"reference_assembly": "CHM13"}, {}),
    Rule("dataset_1000g_reference", 2, "filename", {"dataset_pattern": "ANVIL_1000G_PRIMED_data_model"}, {"reference_assembly": "GRCh38"}, {}),
    Rule("reads_rna_filename", 2, "filename", {"extensions": (".fastq", ".fq"), "filename_pattern": "(?i)_rna_|rnaseq|transcriptome"}, {"data_modality": "transcriptomic.bulk", "data_type": "reads"}, {}),
    Rule("reads_scrna_filename", 2, "filename", {"extensions": (".fastq", ".fq"), "filename_pattern": "(?i)scrna|single.?cell|10x"}, {"data_modality": "transcriptomic.single_cell", "data_type": "reads"}, {}),
    Rule("reads_atac_filename", 2, "filename", {"extensions": (".fastq", ".fq"), "filename_pattern": "(?i)atac"}, {"data_modality": "epigenomic.chromatin_accessibility", "data_type": "reads", "assay_type": "ATAC-seq"}, {}),
    Rule("reads_wgs_filename", 2, "filename", {"extensions": (".fastq", ".fq"), "filename_pattern": "(?i)_wgs_|whole.?genome"}, {"data_modality": "genomic", "data_type": "reads", "assay_type": "WGS"}, {}),
    Rule("fasta_assembly_filename", 2, "filename", {"format": "FASTA", "filename_pattern": "(?i)(assembly|hifiasm|verkko|flye|canu|wtdbg|hap[12]|diploid|[._](pat|mat)(ernal)?[._])"}, {"data_modality": "genomic", "data_type": "assembly"}, {"reference_assembly": "not_applicable"}),
    Rule("fasta_haplotype_filename", 2, "filename", {"format": "FASTA", "filename_pattern": "(?i)(haplotype|phased|hapdup|purge_dups)"}, {"data_modality": "genomic", "data_type": "assembly"}, {"reference_assembly": "not_applicable"}),
    Rule("sc_matrix_atac", 2, "filename", {"extensions": (".h5ad", ".loom", ".mtx"), "filename_pattern": "(?i)atac|peaks"}, {"data_modality": "epigenomic.chromatin_accessibility", "data_type": "expression_matrix", "assay_type": "ATAC-seq"}, {}),
    Rule("nanopore_rna_filename", 2, "filename", {"extensions": (".fast5", ".pod5"), "filename_pattern": "(?i)rna|direct.?rna"}, {"data_modality": "transcriptomic.bulk", "data_type": "raw_signal", "platform": "ONT"}, {}),
    Rule("bed_methylation", 2, "filename", {"extensions": (".bed",), "filename_pattern": "(?i)(modbam2bed|cpg|methylat|bisulfite|wgbs)"}, {"data_modality": "epigenomic.methylation", "data_type": "annotations", "assay_type": "Bisulfite-seq"}, {}),
    Rule("bed_expression", 2, "filename", {"extensions": (".bed",), "filename_pattern": r"(?i)(TMM|TPM|RPKM|FPKM|counts|expression|leafcutter|\.TSS\.)"}, {"data_modality": "transcriptomic.bulk", "data_type": "annotations", "assay_type": "RNA-seq"}, {}),
    Rule("bed_atac_peaks", 2, "filename", {"extensions": (".bed",), "filename_pattern": r"(?i)(\.atac\.|atac[-_]?seq|atacseq)"}, {"data_modality": "epigenomic.chromatin_accessibility", "data_type": "peaks", "assay_type": "ATAC-seq"}, {}),
    Rule("bed_chip_peaks", 2, "filename", {"extensions": (".bed",), "filename_pattern": r"(?i)(\.chip\.|chip[-_]?seq|chipseq|histone|h3k\d+)"}, {"data_modality": "epigenomic.histone_modification", "data_type": "peaks", "assay_type": "ChIP-seq"}, {}),
    Rule("bed_peaks_generic", 1, "filename", {"extensions": (".bed", ".narrowpeak", ".broadpeak"), "filename_pattern": "(?i)(peak|summit|narrowPeak|broadPeak)"}, {"data_modality": "epigenomic.chromatin_accessibility", "data_type": "peaks"}, {}),
    Rule("bed_assembly_qc", 2, "filename", {"extensions": (".bed",), "filename_pattern": r"(?i)(\.hap[12]\.|[\./_]paternal[\./_]|[\./_]maternal[\./_]|\.dip\.bed|\.switch\.|flagger|\.lowQ\.|unreliable|issues\.bed|_genbank\.)"}, {"data_modality": "genomic", "data_type": "annotations"}, {}),
    Rule("bed_regions", 2, "filename", {"extensions": (".bed",), "filename_pattern": r"\.regions\.bed"}, {"data_modality": "genomic", "data_type": "annotations"}, {}),
    Rule("signal_chip", 2, "filename", {"extensions": (".bigwig", ".bw", ".bigWig", ".bedGraph"), "filename_pattern": "(?i)chip|h3k|histone"}, {"data_modality": "epigenomic.histone_modification", "data_type": "signal", "assay_type": "ChIP-seq"}, {}),
    Rule("signal_atac", 2, "filename", {"extensions": (".bigwig", ".bw", ".bigWig", ".bedGraph"), "filename_pattern": "(?i)atac"}, {"data_modality": "epigenomic.chromatin_accessibility", "data_type": "signal", "assay_type": "ATAC-seq"}, {}),
    Rule("signal_rnaseq", 2, "filename", {"extensions": (".bigwig", ".bw", ".bigWig", ".bedGraph"), "filename_pattern": "(?i)rna|transcriptome|coverage"}, {"data_modality": "transcriptomic.bulk", "data_type": "signal"}, {}),
    Rule("intervals_targets", 1, "filename", {"extensions": (".bed",), "filename_pattern": "(?i)targets?|regions?|capture|exome"}, {}, {"data_modality": "not_applicable", "data_type": "not_applicable", "assay_type": "not_applicable", "platform": "not_applicable"}),
    Rule("intervals_chip_peaks", 2, "filename", {"extensions": (".bed", ".narrowpeak", ".broadpeak"), "filename_pattern": "(?i)chip|h3k|histone"}, {"data_modality": "epigenomic.histone_modification", "data_type": "peaks", "assay_type": "ChIP-seq"}, {}),
    Rule("text_stats", 2, "filename", {"extensions": (".txt", ".tsv"), "filename_pattern": r"(?i)\.stats\.txt$|samtools\.stats|mosdepth|flagstat"}, {}, {"data_modality": "not_applicable", "data_type": "not_applicable", "assay_type": "not_applicable", "platform": "not_applicable"}),
    Rule("text_counts", 2, "filename", {"extensions": (".txt", ".tsv", ".csv"), "filename_pattern": r"(?i)counts?\.txt|expression|tpm\.txt|fpkm\.txt"}, {"data_modality": "transcriptomic.bulk", "data_type": "expression_matrix"}, {}),
    Rule("salmon_quant", 2, "filename", {"extensions": (".sf",), "filename_pattern": r"(?i)(^|[._])quant\.sf$"}, {"data_modality": "transcriptomic.bulk", "data_type": "quantification", "assay_type": "RNA-seq"}, {}),
    Rule("platform_pacbio", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@RG", "header_field": "PL", "header_pattern": "PACBIO"}, {"platform": "PACBIO"}, {}),
    Rule("platform_illumina", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@RG", "header_field": "PL", "header_pattern": "ILLUMINA"}, {"platform": "ILLUMINA"}, {}),
    Rule("platform_ont", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@RG", "header_field": "PL", "header_pattern": "ONT"}, {"platform": "ONT"}, {}),
    Rule("platform_ont_alt", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@RG", "header_field": "PL", "header_pattern": "NANOPORE"}, {"platform": "ONT"}, {}),
    Rule("ont_basecall_dna", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@RG", "header_field": "DS", "header_pattern": r"basecall_model=[^;\s]*dna_"}, {"data_modality": "genomic"}, {}),
    Rule("ont_basecall_rna", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@RG", "header_field": "DS", "header_pattern": r"basecall_model=[^;\s]*rna_"}, {"data_modality": "transcriptomic.bulk"}, {}),
    Rule("program_star", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@PG", "header_field": "PN", "header_pattern": "STAR"}, {"data_modality": "transcriptomic.bulk", "data_type": "alignments", "assay_type": "RNA-seq"}, {}),
    Rule("program_hisat2", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@PG", "header_field": "PN", "header_pattern": "hisat2"}, {"data_modality": "transcriptomic.bulk", "data_type": "alignments", "assay_type": "RNA-seq"}, {}),
    Rule("program_tophat", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@PG", "header_field": "PN", "header_pattern": "tophat"}, {"data_modality": "transcriptomic.bulk", "data_type": "alignments", "assay_type": "RNA-seq"}, {}),
    Rule("program_salmon", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@PG", "header_field": "PN", "header_pattern": "salmon"}, {"data_modality": "transcriptomic.bulk", "assay_type": "RNA-seq"}, {}),
    Rule("program_kallisto", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@PG", "header_field": "PN", "header_pattern": "kallisto"}, {"data_modality": "transcriptomic.bulk", "assay_type": "RNA-seq"}, {}),
    Rule("program_bwa", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@PG", "header_field": "PN", "header_pattern": "bwa"}, {"data_modality": "genomic", "data_type": "alignments"}, {}),
    Rule("program_minimap2", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@PG", "header_field": "PN", "header_pattern": "minimap2"}, {"data_modality": "genomic", "data_type": "alignments"}, {}),
    Rule("program_bowtie2", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@PG", "header_field": "PN", "header_pattern": "bowtie2"}, {"data_modality": "genomic", "data_type": "alignments"}, {}),
    Rule("program_ccs", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@PG", "header_field": "PN", "header_pattern": "ccs"}, {"platform": "PACBIO"}, {}),
    Rule("program_isoseq", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@PG", "header_field": "PN", "header_pattern": "isoseq"}, {"data_modality": "transcriptomic.bulk", "platform": "PACBIO", "assay_type": "RNA-seq"}, {}),
    Rule("program_lima", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@PG", "header_field": "PN", "header_pattern": "lima"}, {"platform": "PACBIO"}, {}),
    Rule("header_ref_grch38", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@SQ", "header_field": "SN", "header_pattern": "(?i)(grch38|hg38|hs38)"}, {"reference_assembly": "GRCh38"}, {}),
    Rule("header_ref_grch37", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@SQ", "header_field": "SN", "header_pattern": "(?i)(grch37|hg19|hs37)"}, {"reference_assembly": "GRCh37"}, {}),
    Rule("header_ref_chm13", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@SQ", "header_field": "SN", "header_pattern": "(?i)(chm13|t2t|hs1)"}, {"reference_assembly": "CHM13"}, {}),
    Rule("header_ref_as_grch38", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@SQ", "header_field": "AS", "header_pattern": "(?i)(grch38|hg38|hs38)"}, {"reference_assembly": "GRCh38"}, {}),
    Rule("header_ref_as_grch37", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@SQ", "header_field": "AS", "header_pattern": "(?i)(grch37|hg19|hs37|b37)"}, {"reference_assembly": "GRCh37"}, {}),
    Rule("header_ref_as_chm13", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@SQ", "header_field": "AS", "header_pattern": "(?i)(chm13|t2t|hs1)"}, {"reference_assembly": "CHM13"}, {}),
    Rule("unaligned_no_sq", 3, "header", {"extensions": (".bam", ".cram"), "header_section": "@SQ", "header_absent": True}, {}, {"reference_assembly": "not_applicable"}),
    Rule("vcf_ref_grch38", 3, "vcf_header", {"extensions": (".vcf", ".bcf", ".gvcf", ".g.vcf"), "vcf_header_type": "##reference", "vcf_pattern": r"(?i)(grch38|hg38|hs38|GCA_000001405\.(1[5-9]|[2-9]\d|\d{3,}))"}, {"reference_assembly": "GRCh38"}, {}),
    Rule("vcf_ref_grch37", 3, "vcf_header", {"extensions": (".vcf", ".bcf", ".gvcf", ".g.vcf"), "vcf_header_type": "##reference", "vcf_pattern": r"(?i)(grch37|hg19|hs37|GCA_000001405\.(1[0-4]|[1-9])(?!\d)|b37)"}, {"reference_assembly": "GRCh37"}, {}),
    Rule("vcf_ref_chm13", 3, "vcf_header", {"extensions": (".vcf", ".bcf", ".gvcf", ".g.vcf"), "vcf_header_type": "##reference", "vcf_pattern": "(?i)(chm13|t2t|hs1)"}, {"reference_assembly": "CHM13"}, {}),
    Rule("vcf_contig_grch38", 3, "vcf_header", {"extensions": (".vcf", ".bcf", ".gvcf", ".g.vcf"), "vcf_header_type": "##contig", "vcf_pattern": r"(?i)(grch38|hg38|hs38|GCA_000001405\.(1[5-9]|[2-9]\d|\d{3,}))"}, {"reference_assembly": "GRCh38"}, {}),
    Rule("vcf_contig_grch37", 3, "vcf_header", {"extensions": (".vcf", ".bcf", ".gvcf", ".g.vcf"), "vcf_header_type": "##contig", "vcf_pattern": r"(?i)(grch37|hg19|hs37|GCA_000001405\.(1[0-4]|[1-9])(?!\d)|b37)"}, {"reference_assembly": "GRCh37"}, {}),
    Rule("vcf_contig_chm13", 3, "vcf_header", {"extensions": (".vcf", ".bcf", ".gvcf", ".g.vcf"), "vcf_header_type": "##contig", "vcf_pattern": "(?i)(chm13|t2t|hs1)"}, {"reference_assembly": "CHM13"}, {}),
    Rule("vcf_gatk_haplotypecaller", 3, "vcf_header", {"extensions": (".vcf", ".bcf", ".gvcf", ".g.vcf"), "vcf_header_type": "##source", "vcf_pattern": "(?i)haplotypecaller"}, {"data_modality": "genomic", "data_type": "variants.germline"}, {}),
    Rule("vcf_deepvariant", 3, "vcf_header", {"extensions": (".vcf", ".bcf", ".gvcf", ".g.vcf"), "vcf_header_type": "##source", "vcf_pattern": "(?i)deepvariant"}, {"data_modality": "genomic", "data_type": "variants.germline"}, {}),
    Rule("vcf_gatk_genotypegvcfs", 3, "vcf_header", {"extensions": (".vcf", ".bcf", ".gvcf", ".g.vcf"), "vcf_header_type": "##source", "vcf_pattern": "(?i)genotypegvcfs"}, {"data_modality": "genomic", "data_type": "variants.germline"}, {}),
    Rule("vcf_glnexus", 3, "vcf_header", {"extensions": (".vcf", ".bcf", ".gvcf", ".g.vcf"), "vcf_header_type": "##source", "vcf_pattern": "(?i)glnexus"}, {"data_modality": "genomic", "data_type": "variants.germline"}, {}),
    Rule("vcf_bcftools_call", 3, "vcf_header", {"extensions": (".vcf", ".bcf", ".gvcf", ".g.vcf"), "vcf_header_type": "##source", "vcf_pattern": "(?i)bcftools.*call"}, {"data_modality": "genomic", "data_type": "variants.germline"}, {}),
    Rule("vcf_freebayes", 3, "vcf_header", {"extensions": (".vcf", ".bcf", ".gvcf", ".g.vcf"), "vcf_header_type": "##source", "vcf_pattern": "(?i)freebayes"}, {"data_modality": "genomic", "data_type": "variants.germline"}, {}),
    Rule("vcf_strelka2_germline", 3, "vcf_header", {"extensions": (".vcf", ".bcf", ".gvcf", ".g.vcf"), "vcf_header_type": "##source", "vcf_pattern": "(?i)strelka2.*germline|strelka2(?!.*somatic)"}, {"data_modality": "genomic", "data_type": "variants.germline"}, {}),
    Rule("vcf_mutect2", 3, "vcf_header", {"extensions": (".vcf", ".bcf", ".gvcf", ".g.vcf"), "vcf_header_type": "##source", "vcf_pattern": "(?i)mutect2?"}, {"data_modality": "genomic", "data_type": "variants.somatic"}, {}),
    Rule("vcf_strelka_somatic", 3, "vcf_header", {"extensions": (".vcf", ".bcf", ".gvcf", ".g.vcf"), "vcf_header_type": "##source", "vcf_pattern": "(?i)strelka.*somatic|strelka(?!.*germline)"}, {"data_modality": "genomic", "data_type": "variants.somatic"}, {}),
    Rule("vcf_varscan_somatic", 3, "vcf_header", {"extensions": (".vcf", ".bcf", ".gvcf", ".g.vcf"), "vcf_header_type": "##source", "vcf_pattern": "(?i)varscan.*somatic"}, {"data_modality": "genomic", "data_type": "variants.somatic"}, {}),
    Rule("vcf_somaticsniper", 3, "vcf_header", {"extensions": (".vcf", ".bcf", ".gvcf", ".g.vcf"), "vcf_header_type": "##source", "vcf_pattern": "(?i)somaticsniper"}, {"data_modality": "genomic", "data_type": "variants.somatic"}, {}),
    Rule("vcf_muse", 3, "vcf_header", {"extensions": (".vcf", ".bcf", ".gvcf", ".g.vcf"), "vcf_header_type": "##source", "vcf_pattern": "(?i)muse"}, {"data_modality": "genomic", "data_type": "variants.somatic"}, {}),
    Rule("vcf_manta", 3, "vcf_header", {"extensions": (".vcf", ".bcf"), "vcf_header_type": "##source", "vcf_pattern": "(?i)manta"}, {"data_modality": "genomic", "data_type": "variants.structural"}, {}),
    Rule("vcf_delly", 3, "vcf_header", {"extensions": (".vcf", ".bcf"), "vcf_header_type": "##source", "vcf_pattern": "(?i)delly"}, {"data_modality": "genomic", "data_type": "variants.structural"}, {}),
    Rule("vcf_lumpy", 3, "vcf_header", {"extensions": (".vcf", ".bcf"), "vcf_header_type": "##source", "vcf_pattern": "(?i)lumpy"}, {"data_modality": "genomic", "data_type": "variants.structural"}, {}),
    Rule("vcf_smoove", 3, "vcf_header", {"extensions": (".vcf", ".bcf"), "vcf_header_type": "##source", "vcf_pattern": "(?i)smoove"}, {"data_modality": "genomic", "data_type": "variants.structural"}, {}),
    Rule("vcf_svim", 3, "vcf_header", {"extensions": (".vcf", ".bcf"), "vcf_header_type": "##source", "vcf_pattern": "(?i)svim"}, {"data_modality": "genomic", "data_type": "variants.structural"}, {}),
    Rule("vcf_sniffles", 3, "vcf_header", {"extensions": (".vcf", ".bcf"), "vcf_header_type": "##source", "vcf_pattern": "(?i)sniffles"}, {"data_modality": "genomic", "data_type": "variants.structural"}, {}),
    Rule("vcf_pbsv", 3, "vcf_header", {"extensions": (".vcf", ".bcf"), "vcf_header_type": "##source", "vcf_pattern": "(?i)pbsv"}, {"data_modality": "genomic", "data_type": "variants.structural"}, {}),
    Rule("vcf_cutesv", 3, "vcf_header", {"extensions": (".vcf", ".bcf"), "vcf_header_type": "##source", "vcf_pattern": "(?i)cutesv"}, {"data_modality": "genomic", "data_type": "variants.structural"}, {}),
    Rule("vcf_cnvkit", 3, "vcf_header", {"extensions": (".vcf", ".bcf"), "vcf_header_type": "##source", "vcf_pattern": "(?i)cnvkit"}, {"data_modality": "genomic", "data_type": "variants.cnv"}, {}),
    Rule("vcf_gatk_cnv", 3, "vcf_header", {"extensions": (".vcf", ".bcf"), "vcf_header_type": "##source", "vcf_pattern": "(?i)gatk.*(cnv|copynumber)|modelsegments"}, {"data_modality": "genomic", "data_type": "variants.cnv"}, {}),
    Rule("vcf_canvas", 3, "vcf_header", {"extensions": (".vcf", ".bcf"), "vcf_header_type": "##source", "vcf_pattern": "(?i)canvas"}, {"data_modality": "genomic", "data_type": "variants.cnv"}, {}),
    Rule("vcf_info_somatic", 3, "vcf_header", {"extensions": (".vcf", ".bcf", ".gvcf", ".g.vcf"), "vcf_header_type": "##INFO", "vcf_pattern": "^(SOMATIC|TUMOR_|NORMAL_|TumorVAF|NormalVAF)"}, {"data_type": "variants.somatic"}, {}),
    Rule("vcf_info_sv", 3, "vcf_header", {"extensions": (".vcf", ".bcf"), "vcf_header_type": "##INFO", "vcf_pattern": "^(SVTYPE|SVLEN|CIPOS|CIEND|MATEID|IMPRECISE)$"}, {"data_type": "variants.structural"}, {}),
    Rule("vcf_info_cnv", 3, "vcf_header", {"extensions": (".vcf", ".bcf"), "vcf_header_type": "##INFO", "vcf_pattern": "^(CN|FOLD_CHANGE|PROBES|LOG2_COPY_RATIO)$"}, {"data_type": "variants.cnv"}, {}),
    Rule("fastq_illumina_modern", 3, "fastq_header", {"extensions": (".fastq", ".fq"), "fastq_pattern": r"^@[A-Z0-9-]+:\d+:[A-Z0-9]+:\d+:\d+:\d+:\d+"}, {"platform": "ILLUMINA"}, {}),
    Rule("fastq_illumina_legacy", 3, "fastq_header", {"extensions": (".fastq", ".fq"), "fastq_pattern": r"^@[A-Z0-9-]+:\d+:\d+:\d+:\d+#"}, {"platform": "ILLUMINA"}, {}),
    Rule("fastq_illumina_srr", 3, "fastq_header", {"extensions": (".fastq", ".fq"), "fastq_pattern": r"^@SRR\d+\.\d+"}, {"platform": "ILLUMINA"}, {}),
    Rule("fastq_illumina_hiseq_desc", 3, "fastq_header", {"extensions": (".fastq", ".fq"), "fastq_pattern": " HS2[05]00[-_]"}, {"platform": "ILLUMINA"}, {}),
    Rule("fastq_illumina_ena_hiseq", 3, "fastq_header", {"extensions": (".fastq", ".fq"), "fastq_pattern": r"^@[EDS]RR\d+\.\d+ HS2[05]00"}, {"platform": "ILLUMINA"}, {}),
    Rule("fastq_pacbio_ccs", 3, "fastq_header", {"extensions": (".fastq", ".fq"), "fastq_pattern": r"^@m\d+[A-Za-z]*_\d+_\d+/\d+/ccs"}, {"platform": "PACBIO", "data_type": "reads"}, {}),
    Rule("fastq_pacbio_clr", 3, "fastq_header", {"extensions": (".fastq", ".fq"), "fastq_pattern": r"^@m\d+[A-Za-z]*_\d+_\d+/\d+/\d+_\d+"}, {"platform": "PACBIO", "data_type": "reads"}, {}),
    Rule("fastq_pacbio_generic", 3, "fastq_header", {"extensions": (".fastq", ".fq"), "fastq_pattern": r"^@m\d+[A-Za-z]*_\d+_\d+/\d+"}, {"platform": "PACBIO", "data_type": "reads"}, {}),
    Rule("fastq_ont_uuid", 3, "fastq_header", {"extensions": (".fastq", ".fq"), "fastq_pattern": "^@[a-f0-9]{8}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{12}"}, {"platform": "ONT", "data_type": "reads"}, {}),
    Rule("fastq_ont_metadata", 3, "fastq_header", {"extensions": (".fastq", ".fq"), "fastq_pattern": "runid=[a-f0-9]+"}, {"platform": "ONT", "data_type": "reads"}, {}),
    Rule("fastq_mgi", 3, "fastq_header", {"extensions": (".fastq", ".fq"), "fastq_pattern": r"^@[A-Z]\d{9}L\dC\d{3}R\d{3}\d+"}, {"platform": "MGI"}, {}),
    Rule("fastq_mgi_alt", 3, "fastq_header", {"extensions": (".fastq", ".fq"), "fastq_pattern": r"^@[A-Z]\d+L\d+C\d+R\d+"}, {"platform": "MGI"}, {}),
    Rule("fastq_element", 3, "fastq_header", {"extensions": (".fastq", ".fq"), "fastq_pattern": r"^@[A-Z0-9]+:[A-Z0-9]+:\d+:\d+:\d+:\d+:\d+"}, {"platform": "ELEMENT"}, {}),
    Rule("fastq_ultima", 3, "fastq_header", {"extensions": (".fastq", ".fq"), "fastq_pattern": r"^@[A-Z0-9]+_\d+_\d+_\d+_[ACGT]+"}, {"platform": "ULTIMA"}, {}),
    Rule("fastq_ena_err", 3, "fastq_header", {"extensions": (".fastq", ".fq"), "fastq_pattern": r"^@ERR\d+\.\d+"}, {}, {}),
    Rule("fastq_sra_srr", 3, "fastq_header", {"extensions": (".fastq", ".fq"), "fastq_pattern": r"^@SRR\d+\.\d+"}, {}, {}),
    Rule("fastq_ddbj_drr", 3, "fastq_header", {"extensions": (".fastq", ".fq"), "fastq_pattern": r"^@DRR\d+\.\d+"}, {}, {}),
    Rule("fastq_paired_end", 3, "fastq_header", {"extensions": (".fastq", ".fq"), "fastq_pattern": r"[/\s][12]$|[/\s][12]:|_R[12]_|\.R[12]\.|_r[12]_|\.r[12]\."}, {}, {}),
    Rule("fastq_modality_unknown", 3, "fastq_header", {"extensions": (".fastq", ".fq"), "modality_not_set": True}, {}, {"data_modality": "not_classified"}),
    Rule("intervals_fallback", 2, "filename", {"extensions": (".bed", ".narrowpeak", ".broadpeak"), "modality_not_set": True}, {"data_modality": "genomic", "data_type": "annotations"}, {}),]

# Rules whose match alone makes the assay RNA-seq.
RNA_PROGRAMS = ("program_star", "program_hisat2", "program_tophat", "program_salmon", "program_kallisto", "program_isoseq")


def checked(rules: list[Rule]) -> list[Rule]:
    """rules, if they are well formed; otherwise ValueError names the first fault."""
    seen = set()
    for r in rules:
        faults = [
            r.id in seen and "duplicate id",
            r.tier not in (1, 2, 3) and "bad tier",
            r.scope not in SCOPES and "bad scope",
            {*r.when} - CONDITIONS and "unknown condition",
            {*r.then, *r.status} - {*FIELDS} and "unknown field",
            {*r.then} & {*r.status} and "value and status for one field",
            {*r.status.values()} - {NOT_APPLICABLE, NOT_CLASSIFIED} and "status that can't be claimed",
            isinstance(r.when.get("extensions"), str) and "extensions must be a list",
            any(v not in VOCABULARY.get(f, ()) for f, v in r.then.items()) and "value outside the vocabulary",
        ]
        if fault := next((f for f in faults if f), None):
            raise ValueError(f"rule {r.id}: {fault}")
        seen.add(r.id)
    return sorted(rules, key=lambda r: r.tier)
