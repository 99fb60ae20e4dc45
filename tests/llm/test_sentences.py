from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import sentences as S


def cut(text, drop=None):
    return [text[a:b] for a, b in S.units(text, drop)]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Dr. Ott paid 3.5 p.m. to Co. for it. See Fig. 8.4 and p. 5. Done!", ["Dr. Ott paid 3.5 p.m. to Co. for it.", "See Fig. 8.4 and p. 5.", "Done!"]),
        ("It was Rutar Inc. In short, no. 4 left.", ["It was Rutar Inc.", "In short, no. 4 left."]),
        ("Vgl. S. 457 ff. sowie Bd. 1, z. B. die Tabelle Nr. 4. Die Ordnung.", ["Vgl. S. 457 ff. sowie Bd. 1, z. B. die Tabelle Nr. 4.", "Die Ordnung."]),
        ("“别急着卖！”他说，“再等8天。”热闹的水渠。", ["“别急着卖！”他说，“再等8天。”", "热闹的水渠。"]),
        ("“先别动！看清楚再说。”老师在洄川这样提醒大家。", ["“先别动！看清楚再说。”老师在洄川这样提醒大家。"]),
        ("“价格终究会回来的。”一般来说，好。", ["“价格终究会回来的。”", "一般来说，好。"]),
        ("「本当に？」と聞いて、帰った。次。", ["「本当に？」と聞いて、帰った。", "次。"]),
        ("Le commis demanda : « Est-ce 5,1 ? » puis il partit. Fin !", ["Le commis demanda : « Est-ce 5,1 ? » puis il partit.", "Fin !"]),
        ("他停了一下……又继续写下去。", ["他停了一下……又继续写下去。"]),
        ("涨幅为38.1\n8%，而上一年为4%。", ["涨幅为38.1\n8%，而上一年为4%。"]),
        ("# Title\n\nOne line\nwrapped. Two; three.\n- item one\n- item. two\n| a | b |", ["# Title", "One line\nwrapped.", "Two; three.", "- item one", "- item. two", "| a | b |"]),
        ("甲乙丙 丁戊己 庚辛", ["甲乙丙", "丁戊己", "庚辛"]),
        ("甲乙丙 丁 戊 己庚 辛壬", ["甲乙丙 丁 戊 己庚", "辛壬"]),
        ("Am 3. Mai kam er. Siehe Nr.\n4. Die Lage ist gut.", ["Am 3. Mai kam er.", "Siehe Nr.\n4.", "Die Lage ist gut."]),
        ("Ｄｒ． Ｏｔｔ ｇｉｎｇ． Ｅｎｄｅ", ["Ｄｒ． Ｏｔｔ ｇｉｎｇ．", "Ｅｎｄｅ"]),
        ("甲乙\n丙丁", ["甲乙", "丙丁"]),
        ("นาย ก. บันทึกว่า ราคาเพิ่มขึ้น 19.77 เปอร์เซ็นต์ ในปี 450 ครูใหม่ชอบข้าวสาร", ["นาย ก. บันทึกว่า ราคาเพิ่มขึ้น 19.77 เปอร์เซ็นต์ ในปี 450", "ครูใหม่ชอบข้าวสาร"]),
        ("उसने कहा। “अब मत बेचो!” उसने सुरवन में कहा। अंत।", ["उसने कहा।", "“अब मत बेचो!” उसने सुरवन में कहा।", "अंत।"]),
        ("[本页未提取到文本，可能需要 OCR。]", []),
        ("", []), (None, []), (" \n ", []),
    ],
)
def test_units(text, expected):
    assert cut(text) == expected


def test_long_quotations_and_brackets():
    for n in (3, 40, 400):
        inner = "甲乙丙丁。" * n
        assert cut(f"他说：“{inner}”，然后走了。戊己。") == [f"他说：“{inner}”，然后走了。", "戊己。"]
        assert cut(f"庚辛（{inner}子）壬癸。戊己。") == [f"庚辛（{inner}子）壬癸。", "戊己。"]
        assert cut(f"“甲「{inner}」乙” 便走了。戊己。")[-1] == "戊己。"
        latin = "It went on there. " * n
        assert cut(f"He wrote « {latin}» and left. Then it ended.") == [f"He wrote « {latin}» and left.", "Then it ended."]


def test_unclosed_marks_inside_others():
    assert cut("“甲（乙。丙”，便走了。戊己。丁）。") == ["“甲（乙。丙”，便走了。", "戊己。", "丁）。"]
    assert cut("（甲“乙。丙）。戊己。") == ["（甲“乙。丙）。", "戊己。"]


def test_list_levels():
    text = "- one\n  - two goes\n    on here\n  back under one.\n- three"
    assert cut(text) == ["- one", "- two goes\n    on here", "back under one.", "- three"]


def test_furniture_interrupts_no_unit():
    text = "One sentence goes\nScanned by X\non here. Next\n4"
    assert cut(text, {1, 3}) == ["One sentence goes\nScanned by X\non here.", "Next"]


def test_unclosed_quotation_swallows_nothing():
    assert len(cut("“" + "甲乙丙。" * 300)) >= 300


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab A.。！?”“「」()（）\n\r… 1กข«»\"-#|", max_size=80))
def test_units_are_ordered_slices(text):
    found = S.units(text)
    assert all(a < b <= len(text) and not text[a].isspace() and not text[b - 1].isspace() for a, b in found)
    assert all(x[1] <= y[0] for x, y in zip(found, found[1:], strict=False))


def test_frame(spark):
    rows = [(1, "a。b。", "b1", 1), (2, None, None, None), (None, "c。", "b1", 2), (4, "", "b", 3)]
    df = spark.createDataFrame(rows, "page_key long, text_layer string, book_id string, page int")
    sketch = S.page_sketch(df, ("text_layer",))
    got = S.sentence_units(df, "page_key", "text_layer", "text_layer", sketch).collect()
    assert sorted((r.unit_key or 0, r.unit_no, r.start_char, r.end_char) for r in got) == [(0, 1, 0, 2), (1, 1, 0, 2), (1, 2, 2, 4)]
    assert S.sentence_units(df.limit(0), "page_key", "text_layer", "text_layer", S.page_sketch(df.limit(0), ("text_layer",))).count() == 0


def test_running_lines_do_not_depend_on_the_partitions(spark):
    rows = [(n, "b1", n, f"A Book of Strays\nText number {'x' * n} goes on here.\nIt ends here.") for n in range(1, 13)]
    rows.append((90, "b2", 1, "Another text begins here.\nA Book of Strays\nIt goes on to its end."))
    df = spark.createDataFrame(rows, "page_key long, book_id string, page int, text_layer string")
    got = [S.page_sketch(d, ("text_layer",)).anywhere for d in (df.repartition(13), df.repartitionByRange(2, "page"), df.coalesce(1))]
    assert got[0] == got[1] == got[2] and len(got[0]) == 1
