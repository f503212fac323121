"""Plain Python versions of the statistics, one respondent at a time."""

import math


def theta(rows, metric, r):
    used = [p for p in rows if p[metric] is not None]
    return sum(p["w"][r] * p[metric] for p in used) / sum(p["w"][r] for p in used)


def spread(values, factor=2.0):
    reps = values[1:]
    return factor * math.sqrt(sum((v - values[0]) ** 2 for v in reps) / len(reps))


def thetas(rows, metric):
    if not any(p[metric] is not None for p in rows):
        return None
    return [theta(rows, metric, r) for r in range(len(rows[0]["w"]))]


def contrast(own, rest, metric):
    t, o = thetas(own, metric) if own else None, thetas(rest, metric) if rest else None
    if t is None or o is None:
        return {"mean": None, "se": 0.0, "other_mean": None, "other_se": 0.0, "diff_mean": 0.0, "diff_se": 0.0}
    d = [b - a for a, b in zip(t, o)]
    return {"mean": t[0], "se": spread(t), "other_mean": o[0], "other_se": spread(o, 1.0),
            "diff_mean": d[0], "diff_se": spread(d)}
