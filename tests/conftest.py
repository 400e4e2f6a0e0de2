import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from corpusloom.session import local_session

    session = local_session(cores=8, partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def chat_vocab(spark):
    """Bytes, end of text (256) and the chat tokens (257 to 260)."""
    from corpusloom.operators.vocabulary import byte_vocabulary, extend

    return extend(byte_vocabulary(spark))
