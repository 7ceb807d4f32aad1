import pytest

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa".split()
PASSAGE = " ".join(f"{a}{b}" for a in WORDS[:6] for b in WORDS[6:12])


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names the operators use inside."""
    long_text = "\n".join(" ".join(f"w{k}x{j}" for j in range(50)) for k in range(1200))
    rows = [
        (1, PASSAGE),
        (2, None),
        (3, ""),
        (4, long_text),
        (5, PASSAGE),
        (5, PASSAGE),
        (6, "  \n\t "),
        (7, "tiny"),
        (8, "zero " * 3000),
        (None, PASSAGE),
        (None, None),
        (9, "Ünïcode ß 東京 <|endoftext|> end\n" * 4),
    ]
    shape = (
        "doc_id long, text string, lang string, source string, n_chars long, key string, fp string, words string, row string, "
        "lines_before string, toxicity string, site string, packed string, number string, a string, failed string"
    )
    full = [(i, t, "en", "s", len(t or "")) + ("x",) * 11 for i, t in rows]
    return spark.createDataFrame(full, shape)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
