"""Program lines of alignment headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tools that don't align. Fixed values.
IGNORED = "samtools|picard|markduplicates|gatk|sambamba|bedtools"


def aligner_family(program: Column) -> Column:
    """Family by "id name" of a program line: null for tools, forbidden for unspliced or long-read aligners."""
    p = F.lower(program)
    return F.when(p.rlike(IGNORED), None).when(p.contains("bowtie") | p.contains("minimap"), "forbidden").when(p.contains("star"), "STAR").when(p.contains("hisat"), "HISAT2").otherwise("other")
