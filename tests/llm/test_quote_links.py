from terrawatt.llm.quote_links import link_quotations, parse, threads

A, B, C = "The build fails on Tuesday.\nIt says: no space.", "Delete the cache first.", "That worked, thanks!"
TALK = [
    (1, 0, "user", A),
    (1, 1, "assistant", f"On Monday someone wrote:\n> The build fails   on tuesday.\n> It says: no space.\n\n{B}"),
    (1, 2, "user", "Unrelated question."),
    (1, 3, "user", f"{C}\n\n> > It says: no space.\n> {B}"),
    (1, 4, "other", f">> {B}\n> {C}\nGood."),
    (2, 0, "user", f"> {B}\nNot said here before."),
    (2, 1, "user", "> Not said here before.\n> Not said here before.\nindeed"),
]


def test_parse_levels_passages_and_clean_text():
    body, passages = parse("Hi\n> a  B\n> c\n>> deep\nbye")
    assert body == "Hi\nbye"
    assert passages == [(0, "hi"), (1, "a b c"), (1, "a b"), (1, "c"), (2, "deep"), (0, "bye")]
    assert parse(None) == ("", []) and parse("") == ("", [])
    assert parse("On 1 May X wrote:\n> q")[0] == ""
    assert parse("a > b")[0] == "a > b"


def links(spark, rows, types="conv_id long, turn long, role string, text string"):
    return {(r.conv_id, r.turn): r for r in link_quotations(spark.createDataFrame(rows, types)).collect()}


def test_links_threads_and_positions(spark):
    got = links(spark, TALK)
    parent = {k: r.parent_turn for k, r in got.items()}
    assert parent == {(1, 0): None, (1, 1): 0, (1, 2): None, (1, 3): 1, (1, 4): 3, (2, 0): None, (2, 1): 0}
    assert {k: (r.root_turn, r.depth) for k, r in got.items() if k[0] == 1} == {(1, 0): (0, 0), (1, 1): (0, 1), (1, 2): (2, 0), (1, 3): (0, 2), (1, 4): (0, 3)}
    order = [t for _, t in sorted((r.position, k[1]) for k, r in got.items() if k[0] == 1)]
    assert order == [0, 1, 3, 4, 2]
    assert got[1, 1].text == B and got[1, 4].text == "Good." and ">" not in "".join(r.text for r in got.values())


def test_long_reply_chain(spark):
    rows = [(5, t, "u", (f"> line number {t - 1}\n" if t else "") + f"line number {t}") for t in range(40)]
    got = links(spark, rows)
    assert all((got[5, t].depth, got[5, t].root_turn, got[5, t].position) == (t, 0, t) for t in range(40))


def test_odd_rows(spark):
    rows = [(None, 0, "u", "a"), (None, 1, "u", "> a"), (1, None, "u", "x"), (1, 0, None, None), (1, 0, "u", ""), (1, 1, "u", "> " * 5 + "\n" + "> z" * 20000), (1, 1, "u", "plain"), (1, 1, "u", "plain")]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, hash int, position int")
    got = link_quotations(frame).collect()
    assert len(got) == 8 and all(r.parent_turn is None for r in got)
    assert sorted(r.position for r in got if r.conv_id == 1) == list(range(6))
    assert [r.position for r in got if r.conv_id == 1 and r.turn is None] == [5]
    assert link_quotations(frame.where("false")).collect() == []
    assert threads(spark.createDataFrame([], "conv long, turn long, parent long")).collect() == []
