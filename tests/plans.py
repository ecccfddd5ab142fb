"""Reading physical plans."""


def plan_lines(df):
    """(depth, line) of the plan as it was made, before any run."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [(len(x) - len(x.lstrip(" :+-*()0123456789")), x.strip()) for x in text.splitlines() if x.strip()]


def above(df, leaf):
    """For each scan whose line has `leaf`: what its rows pass through, from below, to the first join."""
    lines, out = plan_lines(df), []
    for i, (depth, line) in enumerate(lines):
        if leaf not in line:
            continue
        path, level = [], depth
        for d, other in reversed(lines[:i]):
            if d < level:
                level = d
                path.append(other)
                if "Join" in other:
                    break
        out.append(path)
    return out
