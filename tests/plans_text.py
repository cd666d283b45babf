"""The text of a physical plan."""

import contextlib
import io


def plan(df, mode: str = "simple") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def executed_plan(df) -> str:
    """The plan after a run, with what adaptive execution has changed."""
    df.collect()
    return plan(df)
