from crewspark.llm.quotes import link_quotes, quoting_messages

SCHEMA = "msg_id long, scope string, text string"


def test_conversation_is_rebuilt(frame):
    rows = [
        (1, "l", "Hello  all\nhow are you?"),
        (2, "l", "> hello all\n> How are   you?\nFine, thanks."),
        (3, "l", ">> Hello all\n>> how are you?\n> Fine, thanks.\nGood to hear."),
        (4, "l", "> > Hello all\n> > how are you?\n> never written\nMe too."),
        (5, "l", "> Good to hear.\n\nand\n\n> Fine, thanks.\nTwo quotes"),
        (6, "m", "> Fine, thanks.\nother list"),
        (7, "l", None), (8, "l", ""), (9, "l", "> Fine, thanks."), (10, None, "Alone"), (11, None, "> alone\nnull scope"), (11, None, "> alone\nnull scope"), (None, "l", "x"),
        (12, "l", "> twelve itself\ntwelve itself"),
    ]
    got = {r["msg_id"]: r for r in link_quotes(frame([(*r, "y") for r in rows], SCHEMA + ", depth string")).collect()}
    parent = {k: (r["parent_id"], r["root_id"], r["depth"]) for k, r in got.items()}
    assert parent == {1: (None, 1, 0), 2: (1, 1, 1), 3: (2, 1, 2), 4: (1, 1, 1), 5: (3, 1, 3), 6: (None, 6, 0), 7: (None, 7, 0), 8: (None, 8, 0), 9: (2, 1, 2), 10: (None, 10, 0), 11: (10, 10, 1), 12: (None, 12, 0)}
    assert got[3]["own_text"] == "Good to hear." and got[7]["own_text"] == got[9]["own_text"] == ""
    assert (got[4]["n_passages"], got[4]["n_linked"]) == (2, 1)
    assert link_quotes(frame([], SCHEMA)).count() == 0


def test_trimmed_quotes(frame):
    first = "Dear all,\nthe meeting is on Monday at nine.\n\nPlease bring the numbers of the last month.\nAnd some cake.\n\nYours"
    rows = [
        (1, "l", first),
        (2, "l", "> please bring the  numbers of the last month.\n> And some cake.\nWhich numbers?"),   # a paragraph
        (3, "l", "> the meeting is on Monday at nine.\nToo early!"),                                    # a line
        (4, "l", "> And some cake.\nWhich one?"),                                                       # a line of three words
        (5, "l", "> Dear all,\n> the meeting is on Monday at nine.\n>\n> [...]\n> Yours\nFine."),       # cut in the middle
        (6, "l", ">> the meeting is on Monday at nine.\n> Too early!\nAgreed."),                        # nested
        (7, "m", "> the meeting is on Monday at nine.\nanother list"),
        (8, "l", "> Which numbers?\n> the meeting is on Monday at nine.\nboth"),                        # no such passage: its line
    ]
    got = {r["msg_id"]: (r["parent_id"], r["root_id"], r["n_linked"]) for r in link_quotes(frame(rows, SCHEMA)).collect()}
    assert got == {1: (None, 1, 0), 2: (1, 1, 1), 3: (1, 1, 1), 4: (None, 4, 0), 5: (1, 1, 1), 6: (3, 1, 2), 7: (None, 7, 0), 8: (1, 1, 1)}


def test_turns_without_number_or_text(frame):
    rows = [(1, 0, "b"), (1, 0, "a"), (1, 1, None), (1, None, "x"), (None, 1, "y"), (2, 0, "one\ntwo words and three more"), (2, 1, "reply")]
    got = {r["msg_id"]: r["text"] for r in quoting_messages(frame([(*r, "r") for r in rows], "conv_id long, turn long, text string, role string")).collect()}
    assert got == {1 << 20: "a", (1 << 20) + 1: "> a", 2 << 20: "one\ntwo words and three more", (2 << 20) + 1: "> two words and three more\nreply"}


def test_long_thread_and_many_lines(frame):
    rows = [(i, "s", (f"> text of {i - 1}\n" if i else "") + f"text of {i}") for i in range(70)] + [(100, "s", "\n".join("> " * (i % 3) + f"line {i}" for i in range(6000)))]
    got = {r["msg_id"]: (r["root_id"], r["depth"]) for r in link_quotes(frame(rows, SCHEMA)).collect()}
    assert all(got[i] == (0, i) for i in range(70))


def test_native_only(spark, frame):
    plan = link_quotes(quoting_messages(frame([(1, 0, "a"), (1, 1, "b")], "conv_id long, turn long, text string")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan
