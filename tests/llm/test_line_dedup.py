from __future__ import annotations

import pytest

from material import ODD
from oracle import compare, connect
from tillhouse.llm import linededup
from tillhouse.llm.queries import ORACLES, QUERIES


def plain(docs):
    """(id, text) pairs without the lines of later windows, in plain Python; ids are unique."""
    seen, out = set(), []
    for d, text in sorted(docs, key=lambda x: x[0]):
        lines = (text or "").split("\n")
        solid = [i for i, x in enumerate(lines) if x.strip(" \t\r")]
        gone = set()
        for k in range(len(solid) - 2):
            window = tuple(lines[i].strip(" \t\r") for i in solid[k : k + 3])
            if window in seen:
                gone.update(solid[k : k + 3])
            seen.add(window)
        out.append((d, None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone)))
    return out


def run(docs):
    return sorted((r.doc_id, r.text, r.n) for r in linededup.drop_repeats(docs, count="n").collect())


def test_query_equals_sql(spark, sf):
    assert compare(QUERIES["op6_three_line_windows"](spark, sf), connect(sf), ORACLES["op6_three_line_windows"]) is None


def test_later_occurrences_go(docs_of):
    texts = [
        "x\na\nb\nc\ny",
        "a\n b \nc\t\r\nd",  # the same but for white space at the ends
        "q\na\nb\n\nc\nz",  # a blank line between stays
        "a\nb\nz",  # two of three lines are no window
        "a\nb\nc\nd",  # overlapping windows merge; nothing is left
        "r\nr\nr\nr\nr",
        *ODD,
    ]
    assert run(docs_of(texts)) == plain(list(enumerate(texts)))


def test_brute_force_over_few_lines(docs_of):
    import random

    rng = random.Random(6)
    texts = ["\n".join(rng.choice("abc ") for _ in range(rng.randrange(12))) for _ in range(120)]
    assert run(docs_of(texts)) == plain(list(enumerate(texts)))


def test_columns_pass_and_repeated_rows_are_one_document(docs_of):
    text = "l1\nl2\nl3\nl4"
    docs = docs_of([text, text, text, "z\nl1\nl2\nl3"], [4, 4, None, 9], at=list("abcd"), solid=list("efgh"), h1=list("ijkl"))
    got = linededup.drop_repeats(docs)
    assert got.columns == docs.columns
    # the row without an id comes first; of the others all lines occurred there
    assert sorted((str(r.doc_id), r.text, r.at) for r in got.collect()) == [("4", "", "a"), ("4", "", "b"), ("9", "z", "d"), ("None", text, "c")]
    same = linededup.drop_repeats(docs_of([text, text], [4, 4]))
    assert [r.text for r in same.collect()] == [text, text]


def test_a_very_long_text_takes_linear_time(docs_of):
    long = "\n".join(f"line {i}" for i in range(60_000))
    got = {r.doc_id: len(r.text) for r in linededup.drop_repeats(docs_of([long, "new\n" + long])).collect()}
    assert got == {0: len(long), 1: len("new")}


def test_empty_table_and_plan_without_python(docs_of, sf, spark, capsys):
    assert linededup.drop_repeats(docs_of([])).collect() == []
    QUERIES["op6_three_line_windows"](spark, sf).explain()
    plan = capsys.readouterr().out
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


@pytest.mark.parametrize("name", ["id", "which", "covers", "first"])
def test_clashing_column_names(docs_of, name):
    docs = docs_of(["a\nb\nc", "a\nb\nc\nd"], **{name: ["1", "2"]})
    assert sorted((r.doc_id, r.text, r[name]) for r in linededup.drop_repeats(docs).collect()) == [(0, "a\nb\nc", "1"), (1, "d", "2")]
