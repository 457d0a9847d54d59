"""Rows that every operator must cope with."""

SF = "/root/testdata/sf0.001"
LONG_WORD = "x" * 3000 + "é" * 3000
LONG_TEXT = " ".join(f"the word{i % 701} of {i % 13}" for i in range(6000))
TEXTS = [
    (1, "The quick brown fox and the lazy dog of the old house."),
    (1, "The quick brown fox and the lazy dog of the old house."),
    (8, "The quick brown fox and the lazy dog of the old house."),
    (2, None),
    (3, ""),
    (None, "a text without an id and the rest of it"),
    (None, "another text without an id and the rest of it"),
    (None, None),
    (4, LONG_WORD),
    (5, LONG_TEXT),
    (6, " \t\n\x1c\x85 "),
    (7, "ﬁ İ ΑΣ ς ＡＢ é <|endoftext|>x<|startoftext|> \x00 漢字 12½ it's 'S"),
    (9, "mail a.b@c.de, call +1 (705) 555-5533 190.1.2.3 or 4111 1111 1111 1111!"),
    (-5, "!!! %%% ???"),
]
