from pyspark.sql import functions as F

from threatlens.llm import linededup as L

LICENSE = "This text may be shared under the license of the house."


def cleaned(df, rules=L.TemplateRules()):
    return {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in L.line_dedup(None, df, rules).collect()}


def test_recurring_lines_go_but_the_first_stays(frame):
    rows = [(i, f"head number {i} of text\nbody of letter{'abcdefgh'[i]} stands here\n{LICENSE}") for i in range(1, 6)]
    rows = [(i, t.replace(str(i), "abcdefgh"[i])) for i, t in rows]
    out = cleaned(frame(rows))
    assert out[1] == (rows[0][1], 3, 0)
    for i, t in rows[1:]:
        assert out[i] == (t.rsplit("\n", 1)[0], 3, 1)


def test_variable_fields_are_generalised(frame):
    rows = [(i, f"intro {'abcdefgh'[i]} words here\nCalled from host-{i}.example at 12:0{i} by user{i}\nend {'abcdefgh'[i]} words there") for i in range(1, 6)]
    out = cleaned(frame(rows))
    assert [out[i][2] for i in range(1, 6)] == [0, 1, 1, 1, 1]
    names = ["anna", "bert", "carl", "dora", "emil"]
    line = "The visitor {} came to the old town hall to read the new book of the house today"
    rows = [(i, f"intro {n} words\n{line.format(n)}\nend {n} words") for i, n in enumerate(names)]
    assert [cleaned(frame(rows))[i][2] for i in range(5)] == [0, 1, 1, 1, 1]


def test_copies_and_clean_documents_keep_their_lines(frame):
    text = "a first line of words\na second line of words\na third line of words"
    rows = [(i, text) for i in range(6)] + [(10 + i, f"quite {c} other\nthan {c} before\nall {c} along") for i, c in enumerate("uvwxyz")]
    out = cleaned(frame(rows))
    assert all(out[i] == (t, 3, 0) for i, t in rows)


def test_a_long_line_in_two_documents_goes_from_the_second(frame):
    # the long line, in words or in characters, needs two documents; the short one three lines
    for line, dropped in ((LICENSE, 1), ("Uninterruptedly misunderstanding internationalisation everywhere", 1), ("so he did", 0)):
        rows = [(1, f"head u of text\n{line}\ntail u of text"), (2, f"head v of text\n{line}\ntail v of text")]
        out = cleaned(frame(rows))
        assert out[1] == (rows[0][1], 3, 0) and out[2][2] == dropped
    names = "anna", "bert"
    line = "The visitor {} came to the old town hall to read the new book of the house today"
    rows = [(i, f"intro {n} words\n{line.format(n)}\nend {n} words") for i, n in enumerate(names)]
    assert [cleaned(frame(rows))[i][2] for i in range(2)] == [0, 0]


def test_blocks_of_lines_go_as_a_whole(frame):
    block = "The first of many lines of the licence stands here\nand the second line of it follows\nthe third line ends it for all"
    names = "uvwxyz"
    own = [f"a quite {c} line of its own document" for c in names]
    places = [f"{{}}\n{block}", f"{block}\n{{}}", f"{{}}\n{block}\n{{}}"]
    for place in places:
        rows = [(i, place.format(f"head {t}", f"tail {t}")) for i, t in enumerate(own)]
        out = cleaned(frame(rows))
        assert out[0] == (rows[0][1], rows[0][1].count("\n") + 1, 0)
        assert all(out[i][2] == 3 and "licence" not in out[i][0] and names[i] in out[i][0] for i in range(1, 6))
    # a document's only line, and exact copies of the first and of another document
    rows = [(0, own[0] + "\n" + LICENSE), (1, LICENSE), (2, own[1] + "\n" + LICENSE), (3, own[0] + "\n" + LICENSE), (4, own[1] + "\n" + LICENSE)]
    out = cleaned(frame(rows))
    assert [out[i][2] for i in range(5)] == [0, 1, 1, 0, 1] and out[0][0] == out[3][0] and out[2][0] == out[4][0] == own[1]


def test_white_space_and_scripts_without_blanks(frame):
    line = "shared words of the house stand in this line"
    rows = [(0, f"u of own\n{line}\nend u"), (1, f"v of own\r\n{line}\r\nend v"), (2, "w of own\n" + line.replace(" ", "\t") + "\nend w")]
    rows += [(3, "x of own\n" + line.replace(" ", "\u00a0") + "\nend x")]
    out = cleaned(frame(rows))
    assert [out[i][2] for i in range(4)] == [0, 1, 1, 1] and out[1][0] == "v of own\r\nend v"
    for long, short in (("本网站的所有内容未经许可不得转载或使用", "第一章"), ("ข้อความทั้งหมดในเว็บไซต์นี้สงวนลิขสิทธิ์", "บทที่"), ("antidisestablishmentarianism", "one two")):
        rows = [(i, f"{c} own line\n{long}\n{short}\n{c} other end") for i, c in enumerate("uvwxyz")]
        out = cleaned(frame(rows))
        assert [out[i][2] for i in range(6)] == [0, 1, 1, 1, 1, 1] and all(short in out[i][0] for i in range(6))
    # years are masked within a line without blanks, and different lines are not
    rows = [(i, f"版权所有二零年{1990 + i}年本网站保留全部权利") for i in range(4)] + [(9, "今天1990我们去公园散步然后回家吃饭")]
    out = cleaned(frame(rows))
    assert [out[i][2] for i in (0, 1, 2, 3, 9)] == [0, 1, 1, 1, 0]


def test_keys_of_many_lines_are_dealt_over_the_partitions(spark, frame, docs, monkeypatch):
    rows = [(i, f"head {'abcdefgh'[i % 8]}{'uvwxyz'[i // 8 % 6]} of text\n{LICENSE}") for i in range(400)] + [(900, LICENSE), (None, LICENSE + "\na b c")]
    df = frame(rows)
    want = sorted(map(tuple, L.line_dedup(None, df).collect()), key=repr), sorted(map(tuple, L.line_dedup(None, docs).collect()), key=repr)
    assert sum(r[2] for r in want[0]) > 300
    monkeypatch.setattr(L, "SAMPLE", 1)
    monkeypatch.setattr(L, "HOT_LINES", 2)
    hot = L.hot_keys(df.select("doc_id", "text"), L.TemplateRules(), 4)
    assert len(hot) == 4
    assert (sorted(map(tuple, L.line_dedup(None, df).collect()), key=repr), sorted(map(tuple, L.line_dedup(None, docs).collect()), key=repr)) == want


def test_edge_cases(frame):
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "one two"), (5, "one two"), (6, "x one two"), (None, LICENSE + "\nu v w"), (8, "q r s\n" + LICENSE), (9, "e f g\n" + LICENSE + "\nh i j")]
    out = cleaned(frame(rows))
    assert out[1] == (None, 0, 0) and out[2] == ("", 1, 0) and out[3] == ("\n\n", 3, 0) and out[4] == ("one two", 1, 0)
    assert sorted(out[i][2] for i in (None, 8, 9)) == [0, 1, 1]
    assert cleaned(frame(rows).filter("doc_id > 99")) == {}


def test_stage_keeps_columns_and_drops_empty_documents(spark, frame):
    rows = [(i, f"head {'abcdefgh'[i]} of text\n{LICENSE}") for i in range(5)] + [(7, LICENSE), (8, ""), (9, None)]
    df = frame(rows).withColumn("lines", F.lit("a column of this name")).withColumn("dropped", F.lit(1))
    out = L.stage(spark, df, "")
    assert out.columns == df.columns
    got = {r["doc_id"]: r for r in out.collect()}
    assert sorted(got) == [0, 1, 2, 3, 4, 8, 9]
    assert got[2]["text"] == "head c of text" and got[2]["n_chars"] == len("head c of text") and got[2]["lines"] == "a column of this name"


def test_plan_is_native(docs):
    plan = L.line_dedup(None, docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
