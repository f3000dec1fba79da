"""What tests of plans look at."""


def plan(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
