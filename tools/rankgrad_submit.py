"""Entry script for spark-submit (ship the package with --py-files):

    spark-submit --py-files rankgrad.zip tools/rankgrad_submit.py \
        --checkpoint-dir hdfs:///shared/ck pagerank-links hdfs:///dump hdfs:///ranks
"""

from rankgrad.cli import main

if __name__ == "__main__":
    main()
