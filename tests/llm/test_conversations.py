from salesops.llm import conversations as cv
from tests.llm.conftest import ODD, SMALL


def test_passages():
    text = "Anna wrote:\n> > first\n>> more\n> second\n>\n> third\nmine\n\nand more"
    assert cv.passages(text) == [(2, "first\nmore"), (1, "second\n\nthird"), (0, "mine\n\nand more")]
    assert cv.passages(None) == [(0, "")]


def linked(frame):
    return {(r.conv_id, r.turn): (r.parent, r.root, r.depth, r.n_quotes, r.n_linked, r.deepest, r.own_text) for r in frame.collect()}


def test_replies(spark):
    rows = [
        (1, 0, "Hello there"),
        (1, 1, "A wrote:\n> hello   THERE\nHi"),
        (1, 2, "B wrote:\n>> Hello there\n> Hi\nWell"),
        (1, 3, "> Hello there\nAnother answer to the first"),
        (1, 4, "> never said\nLost"),
        (1, 200, "> Well\nMuch later"),
        (1, 300, "Hello there"),
        (1, 301, "> Hello there\nTo the second"),
        (2, 5, "> Hello there\nElsewhere"),
    ]
    found = linked(cv.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, text string")))
    assert found == {
        (1, 0): (None, 0, 0, 0, 0, 0, "Hello there"),
        (1, 1): (0, 0, 1, 1, 1, 1, "Hi"),
        (1, 2): (1, 0, 2, 2, 2, 2, "Well"),
        (1, 3): (0, 0, 1, 1, 1, 1, "Another answer to the first"),
        (1, 4): (None, 4, 0, 1, 0, 1, "Lost"),
        (1, 200): (2, 0, 3, 1, 1, 1, "Much later"),
        (1, 300): (None, 300, 0, 0, 0, 0, "Hello there"),
        (1, 301): (300, 300, 1, 1, 1, 1, "To the second"),
        (2, 5): (None, 5, 0, 1, 0, 1, "Elsewhere"),
    }


def test_long_hot_conversation(spark):
    """One scope, one passage said again and again: each quote goes to the latest before it."""
    rows = [(1, k, "same" if k % 3 == 0 else "> same\nreply") for k in range(400)]
    found = linked(cv.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, text string")))
    assert all(found[1, k][0] == (None if k % 3 == 0 else k - k % 3) for k in range(400))
    chain = [(2, k, f"> line {k - 1}\nline {k}") for k in range(300)]
    found = linked(cv.link_quotes(spark.createDataFrame(chain, "conv_id long, turn long, text string")))
    assert all(found[2, k][1:3] == (0, k) for k in range(300))


def test_odd_rows(spark, odd, none):
    frame = odd.withColumnRenamed("doc_id", "turn").selectExpr("if(turn = 3, null, 1L) as conv_id", "*")
    rows = cv.link_quotes(frame).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        if r.turn is None or r.conv_id is None:
            assert r.parent is None and r.depth == 0
    assert cv.link_quotes(cv.as_mail(frame)).where("turn = 6 and parent = 5 and depth > 0").count() == 1
    assert cv.link_quotes(frame.limit(0)).count() == 0 == cv.as_mail(frame.limit(0)).count()


def test_given_turns_are_found_again(spark):
    turns = spark.read.parquet(f"{SMALL}/conversations.parquet")
    found = linked(cv.link_quotes(cv.as_mail(turns)))
    for r in turns.collect():
        parent, root, depth, _, _, _, own = found[r.conv_id, r.turn]
        assert (parent, root, depth) == ((None if r.turn == 0 else r.turn - 1), 0, r.turn)
        assert own == r.text.strip(" \t\n\r")
