"""Spark-native sequencing-data operators on the DataFrame API.

* ``sources``   - FASTQ (line ordinals across splits), chunk files, SAM, dictionary,
                  VCF, BED, FASTA reference chunks, stored alignments
* ``operators`` - reads, pairing, regions, intervals, duplicates, bases (pileup,
                  recalibration, calling), user-function hooks
* ``functions`` - CIGAR, quality and chromosome-name column expressions
* ``sinks``     - chunk files, BED, region strings, ordered VCF, per-region folders
* ``streaming`` - region table and per-chunk counts over arriving aligned chunks
* ``jobs``      - the chunker and the analyser composed from the above
* ``plans``     - test fixtures derived from the driver tables, the query registry,
                  the DuckDB oracle SQL
* ``session``   - session settings, the shared checkpoint folder, checked broadcasts
"""

__version__ = "0.1.0"
