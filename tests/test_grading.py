import random

import pytest
from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift.operators import grading, report

EPISODE = (
    "episode_id long, gt_compliance boolean, verdict boolean, "
    "budget_remaining long, total_budget long"
)
ROW = "episode_id long, pos long, type string, severity string, description string"


def _frame(spark, lists):
    rows = [
        (eid, pos, kind, sev, None)
        for eid, items in lists.items()
        for pos, (kind, sev) in enumerate(items)
    ]
    return spark.createDataFrame(rows, ROW)


H, M, L = "high", "medium", "low"
THREE = [("a", H), ("b", H), ("c", M)]
# truth, flags, verdict right, remaining, total, expected score, capped
PUBLISHED = [
    ([], [("x", L)], False, 3, 83, 0.001, False),
    ([("a", H), ("b", M)], [("b", M)], True, 6, 104, 0.3, True),
    ([("a", H), ("b", M)], [], True, 8, 104, 0.215, True),
    ([("a", H), ("b", L)], [("x", H)], True, 0, 98, 0.1, True),
    (THREE, [*THREE, ("x", M)], True, 2, 119, 0.778, False),
    (THREE, [*THREE, ("a", H), ("x", M)], True, 0, 119, 0.743, False),
    ([("a", H)], [("a", H), ("x", M)], True, 26, 74, 0.755, False),
    (THREE, THREE, True, 20, 119, 0.894, False),
    (THREE, [("a", H), ("c", M)], True, 11, 119, 0.72, False),
    ([], [], True, 50, 50, 0.999, False),
]


def test_published_scores(spark):
    episodes = spark.createDataFrame(
        [
            (i, not gt, (not gt) == right, left, total)
            for i, (gt, _, right, left, total, _, _) in enumerate(PUBLISHED)
        ],
        EPISODE,
    )
    gt = _frame(spark, {i: row[0] for i, row in enumerate(PUBLISHED)})
    flags = _frame(spark, {i: row[1] for i, row in enumerate(PUBLISHED)})
    got = grading.grade_episodes(episodes, gt, flags).orderBy("episode_id").collect()
    for row, case in zip(got, PUBLISHED, strict=True):
        # Published components are rounded before they are summed.
        assert row.final_score == pytest.approx(case[5], abs=0.0015)
        assert row.missed_high == case[6]


def _sequential(truth, claims, compliance, verdict, left, total):
    """The grade of one episode, flag by flag."""
    points = {H: 3, M: 2, L: 1}
    last_truth, last_claim = dict(truth), dict(claims)
    open_truth = [kind for kind, _ in truth]
    hits = []
    for kind, _ in claims:
        if kind in open_truth:
            open_truth.remove(kind)
            hits.append(kind)
    wrong = len(claims) - len(hits)
    hit_weight = sum(points.get(last_truth[k], 1) for k in hits)
    all_weight = sum(points.get(s, 1) for _, s in truth)
    if not claims:
        f1 = 1.0 if not truth else 0.0
    elif not truth or not hits:
        f1 = 0.0
    else:
        p, r = hit_weight / (hit_weight + wrong), hit_weight / all_weight
        f1 = 2 * p * r / (p + r)
    penalty = sum(
        {H: 0.10, M: 0.05, L: 0.03}.get(s, 0.05) for k, s in claims if k not in last_truth
    )
    matched = sum(last_truth[k] == last_claim[k] for k in hits)
    score = 0.2 * (compliance == verdict) + 0.6 * f1 + 0.02 * matched - penalty
    score += 0.2 * left / total if total else 0.0
    high = {k for k, s in truth if s == H}
    missed = bool(high) and not high & set(last_claim)
    if missed:
        score = min(score, 0.3)
    return max(0.0, min(1.0, score)), missed, len(hits), wrong, len(open_truth)


def test_random_episodes_match_a_sequential_grader(spark):
    rng = random.Random(11)
    kinds, severities = list("abcd"), [H, M, L, "odd", "other"]
    cases = {}
    for i in range(800):
        truth = [(rng.choice(kinds), rng.choice(severities)) for _ in range(rng.randrange(5))]
        claims = [(rng.choice(kinds), rng.choice(severities)) for _ in range(rng.randrange(6))]
        total = rng.choice([0, 50, 77, 119])
        cases[i] = (truth, claims, rng.random() < 0.5, rng.random() < 0.5,
                    rng.randint(0, total), total)
    episodes = spark.createDataFrame([(i, *c[2:]) for i, c in cases.items()], EPISODE)
    gt = _frame(spark, {i: c[0] for i, c in cases.items()})
    flags = _frame(spark, {i: c[1] for i, c in cases.items()})
    # The one-pass variant gets flags and endings as rows of one table.
    audit = flags.drop("description").unionByName(
        episodes.drop("gt_compliance").withColumns(
            {"exhausted": F.lit(False), "forced": F.lit(False), "steps": F.lit(1).cast("long")}
        ),
        allowMissingColumns=True,
    ).withColumn("turn_index", F.lit(None).cast("int"))
    counts = grading.audit_counts(audit, gt).join(
        episodes.select("episode_id", "gt_compliance"), "episode_id"
    )
    for graded in (grading.grade_episodes(episodes, gt, flags), grading.score(counts)):
        rows = graded.collect()
        assert len(rows) == len(cases)
        for row in rows:
            total, missed, tp, fp, fn = _sequential(*cases[row.episode_id])
            shown = {1.0: 0.999, 0.0: 0.001}.get(total, total)
            assert row.total == pytest.approx(shown, abs=1e-9) or (
                # A sum of rounded tenths may sit one rounding step off the clamp.
                min(total, 1 - total) < 1e-12
            )
            assert (row.missed_high, row.tp, row.fp, row.fn) == (missed, tp, fp, fn)


def test_reports_hold_every_finding_in_order(spark):
    truth = {1: [("a_b", H)] * 7, 2: []}
    claims = {1: [("x_y", L)] * 5 + [("a_b", L)] * 0, 2: []}
    episodes = spark.createDataFrame(
        [(1, False, True, 10, 80), (2, True, True, 41, 80)], EPISODE
    )
    gt, flags = _frame(spark, truth), _frame(spark, claims)
    graded = grading.grade_episodes(episodes, gt, flags)
    findings = report.report_findings(gt, flags)
    whole = report.draft_reports(graded, findings).orderBy("episode_id").collect()
    assert [f.status for f in whole[0].findings] == ["MISSED"] * 7 + ["FALSE POSITIVE"] * 5
    assert whole[0].findings[0].finding == "A B"
    assert whole[0].verdict_rationale == "7 violation(s) identified: 7 high-severity."
    assert len(whole[0].recommendations) == 7 + 2
    assert whole[0].estimated_human_review_minutes == 26
    assert whole[1].findings == [] and len(whole[1].recommendations) == 1
    assert whole[1].triage_efficiency_pct == round(41 / 80 * 100)
    assert whole[0].recommendations[:7] == [fv.REC_MISSED % "A B"] * 7
    assert whole[0].recommendations[7:] == [fv.REC_TOO_LAX, fv.REC_PRECISION]
