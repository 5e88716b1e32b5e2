"""Line dedup against brute force: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import hashlib
import random

from obsflow.llm.line_dedup import line_dedup

BLANK = " \t\n\x0b\x0c\r"


def fold(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute(rows, min_chars=40, min_docs=5):
    holders = {}
    key = lambda line: fold(line.strip(BLANK))
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            h = holders.get(key(line), ())
            top = max((x for x in h if x is not None), default=None)
            if not (len(h) >= min_docs and i != top):
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, 7, "x", "y") for i, t in rows],
                               "doc_id long, text string, n_lines int, _id string, Drops string").repartition(4)
    got = line_dedup(df, **kw)
    assert "_id" in got.columns
    return sorted(((r.doc_id, r.n_lines, r.n_dropped,
                    hashlib.sha256((r.kept_text if r.kept_text is not None else r.text or "").encode()).hexdigest())
                   for r in got.collect()), key=repr)


def corpus():
    r = random.Random(5)
    pool = ["".join(r.choices("abcdEFÉß \t", k=r.choice([10, 39, 40, 41, 60]))) for _ in range(30)]
    pool += [" \t" + p.upper() + "\x0b\r" for p in pool[:10]] + ["", "é" * 39, "é" * 40, "  " + "é" * 40]
    rows = [(i, "\n".join(r.choices(pool, k=r.randint(0, 30)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "\n"), (None, rows[0][1]), (3, rows[4][1]), (5, rows[5][1]), (5, rows[5][1])]
    rows += [(70 + i, "\n".join([pool[3] + "x" * 40] * 500 + [str(i)] * i)) for i in range(6)]
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    assert run(spark, rows) == brute(rows)


def test_other_parameters(spark):
    rows = corpus()
    assert run(spark, rows, min_chars=10, min_docs=2) == brute(rows, 10, 2)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_main_path_is_native(spark, capsys):
    line_dedup(spark.createDataFrame([(1, "a")], "doc_id long, text string")).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan
