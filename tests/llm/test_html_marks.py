from holdfast.llm.html_blocks import main_text

LONG = [f"Paragraph {k} tells at length what happened on the river that day and why nobody saw it coming at all." for k in range(6)]
BODY = "".join(f"<p>{t}</p>" for t in LONG)


def test_marks_in_dropped_elements_do_not_hide_the_article():
    comments = "<section class='comments'><article><p>I liked this a lot, thank you for the story.</p></article></section>"
    assert main_text(f"<body><div>{BODY}</div>{comments}</body>") == "\n".join(LONG)


def test_cards_do_not_stand_for_the_article():
    cards = "<div><article><p>Another story about boats.</p></article><article><p>A third one about bridges.</p></article></div>"
    assert all(t in main_text(f"<body><div>{BODY}</div>{cards}</body>") for t in LONG)
    assert all(t in main_text(f"<body><main>{BODY}{cards}</main><div>Imprint</div></body>") for t in LONG)


def test_short_lists_and_paragraphs_between_surging_text_stay():
    half = "".join(f"<p>{t}</p>" for t in LONG[:3]), "".join(f"<p>{t}</p>" for t in LONG[3:])
    for short in ("<ul><li>one</li><li>two</li></ul>", "<div><p>one</p><p>two</p></div>"):
        text = main_text(f"<body><div><div>{half[0]}</div>{short}<div>{half[1]}</div></div><div>Imprint</div></body>")
        assert text == "\n".join([*LONG[:3], "one", "two", *LONG[3:]])
