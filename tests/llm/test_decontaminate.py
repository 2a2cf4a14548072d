"""Decontamination against containment, and by example for reworked questions."""

from __future__ import annotations

from holdfast.llm import common, decontaminate

QUESTION = "A train leaves the old station with Anna at 9:30 and travels 120 km to the coast before 9:30 at night"


def test_finds_all_verbatim_items_and_only_them(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in common.table(spark, sf, "documents").collect()}
    items = {r.item_id: r.text for r in common.table(spark, sf, "benchmark").collect()}
    want = {(d, i) for d, text in docs.items() for i, item in items.items() if item in text}
    got = decontaminate.op9_decontamination(spark, sf).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and {r.kind for r in got} == {"verbatim"}


def test_slots_must_agree(spark):
    item = spark.createDataFrame([(1, QUESTION), (2, "too short"), (None, QUESTION), (4, None), (5, "1 2 3 4 5 6 7")], "item_id long, text string")
    same = QUESTION.replace("9:30", "7:15").replace("Anna", "Peter").replace("120", "80")
    mixed = same.replace("7:15 at", "4:45 at").replace("7:15 and", "1:05 and")
    docs = spark.createDataFrame([(1, f"xx {QUESTION} yy"), (2, f"so {same} end"), (3, "nothing of that kind is here today"), (4, None), (5, ""), (6, "1 2 3 4 5 6 7"),
                                  (2, f"so {same} end"), (None, QUESTION)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, item).collect()}
    assert set(got) == {(1, 1), (2, 1), (6, 5)}  # the last one is the item word for word, though it has only numbers
    assert got[1, 1].kind == "verbatim" and got[2, 1].kind == "reworked" and got[2, 1].consistency == 1
    strict = decontaminate.contaminated(docs.where("doc_id = 3").unionByName(spark.createDataFrame([(9, mixed)], "doc_id long, text string")), item, consistency=0.99)
    assert strict.count() == 0


def test_contradicting_values_are_no_copy_at_the_default(spark):
    pens = "Find the total cost when 12 pens are bought for 12 dollars and then 12 more pens are bought by the same man"
    item = spark.createDataFrame([(1, QUESTION), (2, pens)], "item_id long, text string")
    mixed = QUESTION.replace("9:30 and", "4:45 and").replace("9:30 at", "1:05 at")
    other = pens.replace("12 pens", "7 pens").replace("12 dollars", "9 dollars").replace("12 more", "4 more")
    docs = [(1, mixed), (2, other), (3, pens.replace("12", "8")), (4, f"{other} and so on {pens.replace('12', '8')}"), (5, QUESTION.replace("9:30", "4:45"))]
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), item).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(3, 2), (4, 2), (5, 1)}


def test_names_begin_sentences_and_spelling_does_not_matter(spark):
    tom = "Tom has 5 red apples in a basket. Tom gives 2 of them to Anna. How many apples does Tom have left?"
    leeds = "We asked Anna Smith and Peter Brown in the town of Leeds where Mary Jones and Paul Green had met John White"
    item = spark.createDataFrame([(1, tom), (2, leeds)], "item_id long, text string")
    ben = tom.replace("Tom", "Ben").replace("5", "7").replace("2", "3")
    docs = [(1, ben), (2, ben.replace("does Ben", "does Max")), (3, f"so: {ben.replace('How many', 'how many')} yes")]
    docs += [(20 + i, f(leeds)) for i, f in enumerate([str, str.lower, str.upper, str.title, lambda t: t.replace(" ", "\n"), lambda t: t.replace(" ", "\t "), lambda t: t.replace(" ", "  ")])]
    got = {(r.doc_id, r.item_id): r.kind for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), item).collect()}
    assert got == {(1, 1): "reworked", (3, 1): "reworked"} | {(20 + i, 2): "verbatim" for i in range(7)}


def test_odd_input_and_plain_join(spark, odd_docs, no_docs, sf_dir):
    benchmark = common.table(spark, sf_dir, "benchmark")
    assert decontaminate.contaminated(odd_docs, benchmark).count() == 0
    assert decontaminate.contaminated(no_docs, benchmark).count() == 0
    docs = common.table(spark, sf_dir, "documents")
    assert decontaminate.contaminated(docs, benchmark.where("false")).count() == 0
    assert sorted(map(str, decontaminate.contaminated(docs, benchmark, broadcast_rows=0).collect())) == sorted(map(str, decontaminate.contaminated(docs, benchmark).collect()))


def test_runs_short_items_and_items_of_placeholders(spark):
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    item = spark.createDataFrame([(1, " ".join(words)), (2, "1 2 3 4 5 6 7"), (3, "Answer is forty-two"), (4, "Yes"), (5, "what now"), (6, " ".join(words[:10]))], "item_id long, text string")
    docs = [
        (1, "before " + " ".join(words[5:50]) + " behind"),  # 45 of 60 words
        (2, "so 1 2 3 4 5 6 7 it counts"), (3, "we say: ANSWER is\nforty-two!"), (4, "yes."), (5, "well yes and what now then"),
        (6, " ".join(words[20:36])),  # 12 windows
        (7, "1 2 3 4 5 6 8"), (8, " ".join(words[20:37])), (9, "what now?"), (10, "is forty-two")]
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), item).collect()}
    assert got == {(1, 1), (2, 2), (3, 3), (4, 4), (8, 1), (9, 5)}
    fewer = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), item, run=3).collect()}
    assert fewer >= got | {(6, 1)} and (7, 2) not in fewer


def test_a_run_goes_over_repeated_windows(spark):
    """The item repeats a passage, so its later windows stand at earlier places too."""
    part = "alpha beta gamma delta epsilon zeta"
    text = " ".join([part] * 5) + " then an end that differs from all before it and goes on and on for many more words to come"
    item = spark.createDataFrame([(1, text)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x " + " ".join([part] * 5)), (2, f"x {part} y")], "doc_id long, text string")
    assert [r.doc_id for r in decontaminate.contaminated(docs, item).collect()] == [1]
