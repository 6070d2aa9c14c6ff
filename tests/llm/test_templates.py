from pyspark.sql import functions as F

from shiftloom.llm import templates

from .conftest import ODD, words


def cleaned(docs):
    return {(r.doc_id, r.lines, r.dropped): r.text for r in templates.without_templates(docs, "lines", "dropped").collect()}


def test_variable_fields_are_generalised(stored):
    names = ["amber", "basil", "cedar", "denim"]
    rows = [
        (k, f"{words(k, 20)}\norder {k}17 was sent to {names[k % 4]} by express mail today\n{words(50 + k, 12)}", None)
        for k in range(4)
    ]
    found = cleaned(stored(rows))
    assert found[0, 3, 0] == rows[0][1]
    for k in (1, 2, 3):
        assert found[k, 3, 1] == "\n".join(rows[k][1].split("\n")[::2])


def test_rare_short_and_dissimilar_lines_stay(stored):
    rows = [(k, f"ok then\nthe same lead {words(k, 12)}\n{words(99, 9) if k < 2 else words(k, 9)}") for k in range(8)]
    assert all(text == rows[d][1] for (d, _, n), text in cleaned(stored(rows)).items() if n == 0)
    assert len(cleaned(stored(rows))) == 8


def test_many_lines_in_one_document(stored):
    block = "\n".join(words(k, 5) for k in range(150))
    rows = [(k, f"{words(1000 + k, 30)}\n{block}\n{words(2000 + k, 30)}") for k in range(4)]
    found = cleaned(stored(rows))
    assert found[0, 152, 0] == rows[0][1]
    for k in (1, 2, 3):
        assert found[k, 152, 150] == f"{words(1000 + k, 30)}\n{words(2000 + k, 30)}"


def test_odd_rows(stored):
    docs = stored(ODD)
    found = templates.without_templates(docs, "lines", "dropped")
    assert templates.without_templates(docs).columns == docs.columns
    assert found.columns == docs.columns + ["lines", "dropped"] and found.count() == len(ODD)
    by = {r.doc_id: r for r in found.collect()}
    assert by[1].text is None and by[1].lines == 0 and by[2].text == "" and by[2].lines == 1
    # Three documents hold one line: its first place stays.
    same = [r for r in found.collect() if (r.doc_id in (4, 5)) and "another" not in (r.text or "")]
    assert sorted(r.text for r in same) == ["", "", "same text twice over"]
    assert templates.report(stored([], 1)).count() == 0
    assert found.where(F.col("dropped") > 0).count() == 2
