"""A small survey with 4 replicates, awkward on purpose."""

import random

from tallyfold.functions.replicates import SurveyDesign

DESIGN = SurveyDesign.of(4)
METRICS = ("m_plain", "m_constant", "m_sparse", "m_never")
GROUPS = ("asian", "black", "white")


def people(n=400, seed=7):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # one state and one group hold well over a third of everybody
        state = "AA" if rng.random() < 0.5 else rng.choice(["BB", "CC"])
        race = "white" if rng.random() < 0.5 else rng.choice(["asian", "black", None])
        if state == "CC":
            race = rng.choice(["white", None])
        msa = {"AA": "North", "BB": rng.choice(["North", "South", None]), "CC": None}[state]
        base = round(rng.uniform(10, 500), 2)
        rows.append({
            "scram": i, "week": 13 + i % 2, "week_num": f"wk{13 + i % 2}", "state": state, "cbsa_title": msa,
            "race": race,
            "w": [base] + [base * (1.5 if bin(i & r).count("1") % 2 == 0 else 0.5) for r in (1, 2, 3, 4)],
            "m_plain": None if rng.random() < 0.1 else float(rng.random() < 0.3),
            "m_constant": 1.0,
            "m_sparse": float(rng.random() < 0.5) if state == "BB" and race == "asian" else None,
            "m_never": None,
        })
    return rows


def frame(spark, rows):
    names = ["scram", "week", "week_num", "state", "cbsa_title", "race", *METRICS, *DESIGN.columns]
    kinds = ["long", "int", "string", "string", "string", "string"] + ["double"] * (len(METRICS) + 5)
    data = [tuple(p[c] for c in names[:6]) + tuple(p[m] for m in METRICS) + tuple(p["w"]) for p in rows]
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds))
    return spark.createDataFrame(data, schema).repartition(3)
