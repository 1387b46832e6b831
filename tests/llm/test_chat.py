import hashlib

from panelmint.llm import chat

TYPED = f"conv_id long, turn long, role string, parts array<{chat.PART}>"


def part(kind, text=None, ref=None, w=None, h=None, s=None, p=None):
    return (kind, text, ref, w, h, s, p)


def test_escape_round_trip():
    t = chat.Template()
    for text in ("", "<|end|>", "<\\|end|>", "a <|turn|> b </s>[INST] \\<", "[/INST", "<<|image|>>", "[\\\\INST]", "<|im_start|>user", "\\" * 5):
        hidden = t.escape(text)
        assert t.unescape(hidden) == text
        assert not any(m in hidden for m in (*t.MARKS, *t.reserved))


def test_parts_flatten_in_order(spark):
    rows = [
        (1, 0, "user", [part("text", "look "), part("image", ref="a.png", w=57, h=28), part(None, " <|image|> "), part("audio", ref="b.wav", s=2.02), None]),
        (1, 1, "assistant", [part("document", ref="c.pdf", p=2), part("text", None)]),
        (2, 0, "user", None),
    ]
    placed = chat.place_turns(chat.format_turns(spark.createDataFrame(rows, TYPED))).collect()
    a, b, c = sorted(placed, key=lambda r: (r.conv_id, r.turn))
    assert a.formatted == "<|turn|>user<|text|>look <|image|> <\\|image|> <|audio|><|end|>"
    assert [(x.kind, x.ref, x.start, x.tokens) for x in a.attachments] == [("image", "a.png", 5, 3), ("audio", "b.wav", 26, 51)]
    assert a.formatted[a.content_start + 5 :].startswith("<|image|>") and a.formatted[a.content_start + 26 :].startswith("<|audio|>")
    assert (b.attachments[0].tokens, b.start, b.learned, c.content_chars) == (1536, len(a.formatted), True, 0)


def test_read_back_equals_brute_force(spark):
    rows = [(c, t, role, text) for c in (3, None) for t, role, text in ((2, "assistant", "b\n"), (0, "user", None), (1, None, "</s>"), (1, "assistant", "<|end|>x"), (1, "assistant", "<|end|>x"))]
    rows.append((-1, 0, "assistant", "😀[INST]"))
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumnRenamed("x", "x")
    got = {r.conv_id: r for r in chat.read_back(chat.place_turns(chat.format_turns(given))).collect()}
    for conv in (3, None, -1):
        turns = sorted(((t, role or "", text or "") for c, t, role, text in rows if c == conv))
        digest = hashlib.sha256("".join(f"{role}\n{text}\n" for _, role, text in turns).encode()).hexdigest()
        loss = "".join(text for _, role, text in turns if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_whole_texts_and_empty(spark):
    given = spark.createDataFrame([(1, 1, "assistant", "yes"), (1, 0, "user", "no")], "conv_id long, turn long, role string, text string")
    assert chat.whole_texts(chat.place_turns(chat.format_turns(given))).first().formatted == "<|turn|>user<|text|>no<|end|><|turn|>assistant<|text|>yes<|end|>"
    assert chat.read_back(chat.place_turns(chat.format_turns(given.limit(0)))).count() == 0
