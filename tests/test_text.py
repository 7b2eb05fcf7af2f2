from pyspark.sql import functions as F

from quarry.functions import porter
from quarry.functions import text as TF
from quarry.operators import text as TX


def test_porter_reference_pairs():
    # examples from the 1980 paper
    pairs = {"caresses": "caress", "ponies": "poni", "ties": "ti", "cats": "cat",
             "feed": "feed", "agreed": "agre", "plastered": "plaster", "motoring": "motor",
             "sing": "sing", "conflated": "conflat", "hopping": "hop", "filing": "file",
             "happy": "happi", "relational": "relat", "conditional": "condit",
             "generalization": "gener", "hopeful": "hope", "goodness": "good",
             "revival": "reviv", "adjustable": "adjust", "controll": "control", "roll": "roll"}
    for w, s in pairs.items():
        assert porter.stem(w) == s, (w, porter.stem(w), s)


def test_html_to_text_by_hand(spark):
    html = ("<html><head><title>t</title></head><body><a href='x'>link</a><p>A &amp; B</p>"
            "\n\n\n<b>bold</b> &lt;x&gt;</body></html>")
    df = spark.createDataFrame([(html,), ("no tags",), (None,), ("",)], "h string")
    got = [r[0] for r in df.select(TF.html_to_text("h")).collect()]
    assert got == [" HYPERLINK linkA & B\nbold <x>", "no tags", None, ""]


def test_word_counts_pipeline(spark):
    df = spark.createDataFrame([(1, "Hello, hello WORLD! Visit http://x.org/a?b=1 now 3.14e5 times")],
                               "id long, text string")
    wc = {r["word"]: r["count"] for r in TX.word_counts(df, "id", "text").collect()}
    assert wc["hello"] == 2 and wc["URL"] == 1 and wc["NUMBER"] == 1 and "world" in wc


def test_email_parsing(spark):
    mails = [
        b"Subject: plain one\nContent-Type: text/plain\n\nhello there",
        b"Subject: html\nContent-Type: text/html\n\n<html><body><a href='u'>x</a> hi</body></html>",
        (b'Subject: multi\nMIME-Version: 1.0\nContent-Type: multipart/alternative; boundary="b"\n\n'
         b"--b\nContent-Type: text/plain\n\nplain part\n--b\nContent-Type: text/html\n\n<p>h</p>\n--b--\n"),
        b"Subject: bad\nContent-Type: text/plain; charset=unknown-8bit\n\ncaf\xe9",
    ]
    df = spark.createDataFrame([(i, bytearray(m)) for i, m in enumerate(mails)], "id int, content binary")
    out = {r["id"]: r for r in TX.parse_mails(df).collect()}
    assert out[0]["structure"] == "text/plain" and out[0]["text"].strip() == "hello there"
    assert out[1]["structure"] == "text/html" and "HYPERLINK" in out[1]["text"]
    assert out[2]["structure"] == "multipart(text/plain, text/html)"
    assert out[2]["text"].strip() == "plain part"
    assert out[3]["subject"] == "bad" and out[3]["text"] == "café"


def test_email_nesting(spark):
    def multi(mark, *parts):
        return f'Content-Type: multipart/mixed; boundary="{mark}"\n\n' + "".join(
            f"--{mark}\n{p}\n" for p in parts) + f"--{mark}--\n"
    plain, html = "Content-Type: text/plain\n\nhi", "Content-Type: text/html\n\n<b>h</b>"
    image = "Content-Type: image/png\n\nx"
    mails = [multi("a", multi("b", plain, html), image), multi("a", multi("b", html), multi("c", html, image), plain),
             multi("a", multi("b", multi("c", html)))]
    df = spark.createDataFrame([(i, bytearray(m.encode())) for i, m in enumerate(mails)] + [(3, None)], "id int, content binary")
    out = {r["id"]: (r["structure"], r["text"], r["subject"]) for r in TX.parse_mails(df).collect()}
    assert out[0] == ("multipart(multipart(text/plain, text/html), image/png)", "hi", None)
    assert out[1] == ("multipart(multipart(text/html), multipart(text/html, image/png), text/plain)", "hi", None)
    assert out[2] == ("multipart(multipart(multipart(text/html)))", "h", None)
    assert out[3] == (None, None, None)


def test_vocabulary_ties_by_word(spark):
    c = spark.createDataFrame([(1, "b", 2), (1, "a", 2), (2, "c", 1)], "id int, word string, count long")
    v = [(r["word"], r["idx"]) for r in TX.fit_vocabulary(c, 2).orderBy("idx").collect()]
    assert v == [("a", 1), ("b", 2)]
