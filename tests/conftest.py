import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from kindling.session import get_session

    # Tests run where no cluster names a checkpoint folder: use a private one.
    ckpt = tempfile.mkdtemp(prefix="kindling-test-ckpt-")
    s = get_session("local[4]", 8, "kindling-tests", {"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


def _key(t):
    # None sorts last within a column; values of one column share a type.
    return tuple((v is None, v if v is not None else 0) for v in t)


def rows(df, *cols):
    """Rows as sorted tuples (None last) for order-insensitive comparison."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)


def explain_text(df, mode="formatted"):
    """The physical plan as text (``DataFrame.explain`` prints it)."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
