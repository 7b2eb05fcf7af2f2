"""Rows that the tests of several operators share."""

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977} and some more" for i in range(30_000))
ODD = [(1, "One small text with some words in it."), (None, "a row without an id"), (2, None), (3, ""),
       (4, "   \n\t "), (5, "!!! ... 123"), (6, "One small text with some words in it."),
       (1, "One small text with some words in it."), (7, LONG), (8, "é日本 🙂 ﬁ ǅ \x00 \x1f"),
       (9, "<|endoftext|> <s> </s>  two  spaces\r\n")]
