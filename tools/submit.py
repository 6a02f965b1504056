"""Launcher for spark-submit (which runs files, not modules):

    spark-submit --master yarn --conf spark.checkpoint.dir=hdfs:///shared/ckpt \\
        --py-files shelfwise.zip tools/submit.py load --master ... --transactions ... --warehouse ...
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfwise.__main__ import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
