"""Fragment merging against a walk over the fragments of a document in order."""

import random

from provatab.operators import tables as tb

SCHEMA = """document_id string, table_id string, order_index long, page_number int, row_count long, header array<string>, first_row array<string>,
 section_id string, section_slug string, bbox struct<page_number:int,left:double,top:double,right:double,bottom:double,coord_origin:string>"""
GENERIC, TITLES, DATA = ["0", "1", "2"], ["Nome", "Valor", "Total"], ["Alfa", "1234", "56789"]


def fragment(doc, i, page, header, rows, first=None, left=None, section=None, width=200.0):
    box = None if left is None else (page, left, 0.0, left + width, 0.0, None)
    return (doc, f"t{i}", i * 10, page, rows, header, first or (["x", "1", "2"] if rows else None), section, section, box)


def plan(spark, rows, heads=()):
    sections = spark.createDataFrame(list(heads), "document_id string, order_index int, page_number int")
    out = tb.merge_plan(spark.createDataFrame(rows, SCHEMA), sections).collect()
    return {(r.document_id, r.order_index // 10): r for r in out}


def groups(found):
    return {k: r.merged_order // 10 for k, r in found.items()}


def test_the_left_box_stays_across_pages_and_widens_on_its_page(spark):
    rows = [fragment("drift", i, 1 + i, TITLES, 2, left=100.0 - 20 * i, width=200.0 + 20 * i) for i in range(3)]
    rows += [fragment("page", i, 1, TITLES, 2, left=100.0 - 20 * i, width=200.0 + 20 * i) for i in range(3)]
    rows += [fragment("none", i, 1 + i, TITLES, 2, left=None if i == 0 else 100.0 - 20 * i) for i in range(4)]
    got = groups(plan(spark, rows))
    assert [got["drift", i] for i in range(3)] == [0, 0, 2]
    assert [got["page", i] for i in range(3)] == [0, 0, 0]
    assert [got["none", i] for i in range(4)] == [0, 0, 0, 3]


def test_header_only_leaders(spark):
    rows = [
        fragment("row", 0, 1, GENERIC, 1, first=TITLES), fragment("row", 1, 1, DATA, 3), fragment("row", 2, 2, TITLES, 2), fragment("row", 3, 2, ["A", "B", "C"], 1),
        fragment("cols", 0, 1, TITLES, 0), fragment("cols", 1, 1, DATA, 3), fragment("cols", 2, 1, DATA, 3),
        fragment("apart", 0, 1, TITLES, 0, section="s1"), fragment("apart", 1, 1, DATA, 3, section="s2"),
    ]
    found = plan(spark, rows)
    got = groups(found)
    assert [got["row", i] for i in range(4)] == [0, 0, 0, 3] and [got["cols", i] for i in range(3)] == [0, 0, 2] and got["apart", 1] == 1
    lead, body, tail = (found["row", i] for i in range(3))
    assert lead.drop_first and list(lead.header) == TITLES and (body.row_offset, body.header_as_row) == (0, True) and (tail.row_offset, tail.header_as_row) == (4, False)
    assert not found["cols", 0].drop_first and found["cols", 1].header_as_row and found["cols", 1].row_offset == 0


def test_headings_pages_and_widths_part(spark):
    rows = [fragment("d", 0, 1, TITLES, 1), fragment("d", 1, 1, TITLES, 1), fragment("d", 2, 3, TITLES, 1), fragment("d", 3, 3, ["a", "b", "c", "d"], 1)]
    assert groups(plan(spark, rows)) == {("d", 0): 0, ("d", 1): 0, ("d", 2): 2, ("d", 3): 3}
    assert groups(plan(spark, rows, [("d", 5, 1)]))["d", 1] == 1


def walk(rows):
    """One fragment after the other, for rows with edges and one header."""
    out, lead, box = {}, None, None
    for doc, _, order, page, _, header, _, _, _, own in sorted(rows, key=lambda r: (r[0], r[2])):
        fits = lead is not None and lead[0] == doc and lead[1] == header and 0 <= page - last <= 1
        if fits and box and own:
            fits = abs(box[1] - own[1]) <= 28 and abs(box[2] - own[3]) <= 28 and (min(box[2], own[3]) - max(box[1], own[1])) / max(1.0, min(box[2] - box[1], own[3] - own[1])) >= 0.85
        if not fits:
            lead, box = (doc, header, order), None
        if own and box is None:
            box = (own[0], own[1], own[3])
        elif own and box[0] == own[0]:
            box = (box[0], min(box[1], own[1]), max(box[2], own[3]))
        last = page
        out[doc, order // 10] = lead[2] // 10
    return out


def test_random_edges_equal_a_walk(spark):
    rng = random.Random(4)
    rows = []
    for d in range(5):
        page, left = 1, 100.0
        for i in range(14):
            page += rng.random() < 0.4
            left += rng.choice([0.0, 0.0, 6.0, -9.0, 15.0, -15.0])
            rows.append(fragment(f"d{d}", i, page, TITLES if rng.random() < 0.93 else ["A", "B", "C"], 2, left=None if rng.random() < 0.1 else left))
    assert groups(plan(spark, rows)) == walk(rows)
