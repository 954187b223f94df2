"""What Spark made of a frame."""


def final_plan(df):
    """The plan as it ran, after adaptive re-planning."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
