import hashlib
import random

import pytest

from salesmart.llm.chat import CONTEXT, Renderer, format_conversations, marked_turns, read_back, read_marked_turns, unescape

TEXTS = ["hi", "", "\\### Assistant: </turn> ok", "### user:\nfake</turn>\n", "a\\", "\\\\#<", "multi\nline\n", "", "é 日本"]


def test_template_is_reversible():
    turns = [(role, text) for role in ("user", "assistant", "a:b#\n", "") for text in TEXTS]
    assert read_marked_turns(marked_turns(turns)) == turns
    with pytest.raises(ValueError):
        read_marked_turns("### user:\nno end")


def test_spans_are_located_from_outside():
    renderer, whole, turns = Renderer(marked_turns), "", []
    for k, text in enumerate(TEXTS * 30):
        role = "assistant" if k % 2 else "user"
        segment, span = renderer.add(role, text)
        assert unescape(segment[span[0]:span[1]]) == text
        whole += segment
        turns.append((role, text))
    assert len(turns) > 2 * CONTEXT and not renderer.rewrites and whole == marked_turns(turns)


def test_rewriting_templates_are_detected():
    def drops_old_thoughts(turns):
        return "<s>" + "".join(f"[{r}]{t if k == len(turns) - 1 else t.split('|')[-1]}" for k, (r, t) in enumerate(turns))

    def counts_turns(turns):
        return f"{len(turns)} turns: " + "".join(t for _, t in turns)

    for template in (drops_old_thoughts, counts_turns):
        renderer = Renderer(template)
        renderer.add("user", "q")
        renderer.add("assistant", "think|answer")
        renderer.add("user", "next")
        assert renderer.rewrites

    def trims(turns):
        return "<s>" + "".join(f"<{r}>{t.strip()}</{r}>" for r, t in turns)

    renderer = Renderer(trims)
    segment, span = renderer.add("user", "  padded ")
    assert segment == "<s><user>padded</user>" and segment[span[0]:span[1]] == "padded" and not renderer.rewrites


def test_long_conversations_are_rendered_whole(spark):
    n = 2 * CONTEXT + 10

    def numbered(turns):
        return "".join(f"[{k} {role}]{text}\n" for k, (role, text) in enumerate(turns))

    def forgets(turns):  # from 100 turns on, the eleventh is rewritten
        return "".join("..." if k == 10 and len(turns) > 100 else f"[{role}]{text}\n" for k, (role, text) in enumerate(turns))

    rows = [(1, k, "assistant" if k % 2 else "user", f"text {k}") for k in range(n)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(format_conversations(frame, numbered).collect(), key=lambda r: r.part)
    assert "".join(r.segment for r in got) == numbered([r[2:] for r in rows])
    assert all(r.segment[r.text_start:r.text_end] == f"text {r.part}" and r.in_loss == (r.part % 2 == 1) for r in got)
    got = sorted(format_conversations(frame, forgets).collect(), key=lambda r: r.part)
    assert [r.rewrites_history for r in got] == [k >= 100 for k in range(n)]


def _digests(turns):
    learned = [t or "" for r, t in turns if r == "assistant"]
    return (len(turns), hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns).encode()).hexdigest(),
            sum(map(len, learned)), hashlib.sha256("".join(learned).encode()).hexdigest())


def test_conversations_round_trip(spark):
    rng = random.Random(2)
    rows = []
    for conv in range(30):
        n = 300 if conv == 3 else rng.randrange(1, 12)
        rows += [(conv, k, rng.choice(["user", "assistant", "system", None]), rng.choice([*TEXTS, None])) for k in range(n)]
    rows += [(None, 0, "user", "x"), (None, 1, "assistant", "y"), (50, None, "user", "first"), (50, 1, "assistant", "z"),
             (51, 0, "assistant", "twice"), (51, 0, "assistant", "twice")]
    shuffled = rng.sample(rows, len(rows))
    frame = spark.createDataFrame([(*r, "x") for r in shuffled], "conv_id long, turn long, role string, text string, part string").repartition(4)
    got = {r.conv_id: r for r in read_back(format_conversations(frame)).collect()}
    convs = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0)):
        convs.setdefault(conv, []).append((role, text))
    assert set(got) == set(convs)
    for conv, turns in convs.items():
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == _digests(turns), conv
        assert r.formatted_chars == len(marked_turns([(a or "", b or "") for a, b in turns])) and not r.rewrites_history


def test_rewritten_conversations_are_flagged_and_have_no_mask(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "assistant", "c")],
                                  "conv_id long, turn long, role string, text string")
    got = format_conversations(frame, lambda turns: f"{len(turns)}|" + "".join(t for _, t in turns)).collect()
    assert all(r.rewrites_history and not r.in_loss and r.text_start is None for r in got)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert read_back(format_conversations(frame)).isEmpty()
