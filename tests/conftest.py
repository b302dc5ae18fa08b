import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from amphora.session import get_spark  # noqa: E402

FIXTURES = os.path.join(os.path.dirname(__file__), "fixtures")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("amphora-tests", master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def proteins(spark):
    from amphora.sources import catalog
    from amphora.sources.sequences import attach_sequences, read_sequence_files

    seqs = read_sequence_files(spark, os.path.join(FIXTURES, "sequences"))
    return attach_sequences(catalog.proteins(spark), seqs).cache()
