"""Line deduplication against brute force; no Python on the executors."""

import random

from llm_cases import docs  # noqa: F401

from quizframe.llm.line_dedup import dedup_lines


def brute_force(rows):
    """(id, text, removed) per row; repeated (id, text) rows count once."""
    order = lambda i: (i is None, i or 0)
    seen = {}
    for i, text in {(i, t) for i, t in rows if t is not None}:
        lines = ["\nbegin", *["" if not x.strip(" ") else x for x in text.split("\n")], "\nend"]
        for p in range(len(lines) - 2):
            w = tuple(lines[p : p + 3])
            if any(x and x[0] != "\n" for x in w):
                seen.setdefault(w, []).append((i, text, p - 1))
    gone = {}
    for w, places in seen.items():
        if len(places) > 1:
            first = min((i for i, _, _ in places), key=order)
            kept = set()
            for i, text, p in sorted(places, key=lambda x: (order(x[0]), x[1], x[2])):
                if i == first and (i, text) not in kept:
                    kept.add((i, text))
                else:
                    gone.setdefault((i, text), set()).update({p, p + 1, p + 2} & set(range(text.count("\n") + 1)))
    out = []
    for i, text in rows:
        cut = gone.get((i, text), set())
        left = text if text is None else "\n".join(x for p, x in enumerate(text.split("\n")) if p not in cut)
        out.append((i, left, len(cut)))
    return sorted(out, key=str)


def found(frame):
    return sorted(((r["doc_id"], r["text"], r["n_removed"]) for r in frame.select("doc_id", "text", "n_removed").collect()), key=str)


def test_random_documents(spark, docs):  # noqa: F811
    for seed in (1, 2):
        rng = random.Random(seed)
        rows = [(i, "\n".join(rng.choices(["a", "b", "c", "", " ", "dd"], k=rng.randint(0, 12)))) for i in range(120)]
        rows += [(200 + i, "\n".join(f"line {rng.randint(0, 60)}" for _ in range(rng.randint(0, 40)))) for i in range(40)]
        assert found(dedup_lines(docs(rows))) == brute_force(rows)


def test_short_texts_take_part(spark, docs):  # noqa: F811
    one, two = "one long line of words", "first line\nsecond line"
    rows = [(1, one), (2, one), (3, two), (4, two), (5, two + "\nthird"), (6, "zero\n" + two), (7, one + "\n" + two), (8, " "), (9, " "), (10, "")]
    result = found(dedup_lines(docs(rows)))
    assert result == brute_force(rows)
    left = {i: t for i, t, _ in result}
    # Copies of short texts go; two lines go where a text begins or ends with them, as earlier texts do.
    assert (left[2], left[4], left[5], left[6]) == ("", "", "third", "zero") and left[1] == one and left[8] == left[9] == " "


def test_nulls_empties_repeats_long_texts_and_clashing_columns(spark, docs):  # noqa: F811
    license_ = "one\ntwo\nthree\nfour"
    rows = [
        (1, None), (2, ""), (3, "\n\n\n\n"), (4, "\n\n\n\n"), (5, license_), (6, "x\n" + license_ + "\ny"), (6, "x\n" + license_ + "\ny"),
        (7, "x\n" + license_), (None, license_), (8, "same\n" * 50), (9, "\n".join(f"u{i}" for i in range(30_000)) + "\n" + license_),
    ]
    frame = docs(rows).selectExpr("*", "'q' as n_removed", "'q' as id", "'q' as row", "'q' as starts", "'q' as begins", "'q' as lines")
    result = dedup_lines(frame)
    assert found(result) == brute_force(rows)
    assert result.columns == [c for c in frame.columns if c != "n_removed"] + ["n_removed"]
    assert {r["id"] for r in result.collect()} == {"q"}


def test_empty_table_and_plan(spark, docs):  # noqa: F811
    assert dedup_lines(docs([])).collect() == []
    plan = dedup_lines(docs([(1, "a\nb\nc")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
