"""Formatting read back, other templates, and long conversations."""

import hashlib

import pytest
from hypothesis import given, settings, strategies as st

from paperloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, segment string, `long_id` long"


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    convs = {}
    for conv_id, turn, role, text in rows:
        convs.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    found = []
    for conv_id, turns in convs.items():
        turns.sort()
        said = [t[3] for t in turns if t[2] == "assistant"]
        whole = chat.marked_turns([(t[2], t[3]) for t in turns])
        digest = sha("".join(f"{t[2]}\n{t[3]}\n" for t in turns))
        found.append((conv_id, len(turns), digest, sum(map(len, said)), sha("".join(said)), len(whole), False))
    return sorted(found, key=repr)


def digests(spark, rows):
    return sorted((tuple(r) for r in chat.digests(table(spark, rows)).collect()), key=repr)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<|\\im_startend>\na ", max_size=30), st.text(alphabet="<|\\n\nab", max_size=12))
def test_escapes_are_reversible(text, role):
    assert chat.unescape(chat.escape(text)) == text
    assert chat.unescape_role(chat.escape_role(role)) == role
    assert "<|" not in chat.escape(text) and "<|" not in chat.escape_role(role) and "\n" not in chat.escape_role(role)
    turns = [(role, text), ("assistant", text + "<"), ("user", "|" + text)]
    assert list(chat.read_turns(chat.marked_turns(turns))) == turns


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", "Hi"),
        (1, 1, "assistant", "<|im_end|><|im_start|>assistant ok"),
        (1, 1, "assistant", "<|im_end|><|im_start|>assistant ok"),
        (1, 1, "assistant", ""),
        (1, None, None, None),
        (2, 5, "assistant", "only an answer, é😀"),
        (3, 0, "user\n<|x", "a" * 200_000),
        (3, -4, "system", "first"),
        (None, 0, "user", "no id"),
        (None, 1, "assistant", "none"),
    ]
    assert digests(spark, rows) == expected(rows)


def test_empty(spark):
    assert digests(spark, []) == []


def test_long_conversations_are_split(spark):
    rows = [(7, t, ("user", "assistant")[t % 2], f"turn {t}") for t in range(3 * chat.SEGMENT + 10)]
    rows += [(8, t * 1000, ("user", "assistant")[t % 2], f"far {t}") for t in range(6)]
    rows += [(9, 3, "assistant", f"tied {i:05}") for i in range(2 * chat.TURNS_PER_ROW + 5)]
    parts = chat.format_turns(chat.plain_turns(table(spark, rows))).collect()
    assert len({(r["conv_id"], r["segment"]) for r in parts if r["conv_id"] == 7}) == 4
    assert max(len(r["spans"]) for r in parts) <= chat.TURNS_PER_ROW
    for row in parts:
        for span in row["spans"]:
            piece = row["text"][span["start"] : span["end"]]
            assert piece.startswith(chat.START) and piece.endswith(chat.END + "\n")
            if span["loss_start"] is not None:
                assert piece == f"{chat.START}assistant\n{row['text'][span['loss_start']:span['loss_end']]}{chat.END}\n"
    assert digests(spark, rows) == expected(rows)


def rendered(template, turns):
    rows = [(1, 0, False, role, text) for role, text in turns]
    return list(chat._format_rows(iter(rows), template))


def thoughts_dropped(turns, prompt):
    """Keeps the thinking of the last answer only, as some published templates do."""
    out = ""
    for i, (role, text) in enumerate(turns):
        if role == "assistant" and i < len(turns) - 1:
            text = text.split("</think>")[-1]
        out += f"[{role}]{text}[/]"
    return out + ("[assistant]" if prompt else "")


def test_rewritten_history_is_found():
    turns = [("user", "q"), ("assistant", "<think>x</think>a"), ("user", "r"), ("assistant", "b")]
    (row,) = rendered(thoughts_dropped, turns)
    assert row[3] is None and row[4] == [] and row[5] == 2
    (row,) = rendered(thoughts_dropped, [("user", "q"), ("assistant", "a"), ("user", "r")])
    assert row[5] is None and row[3] == "[user]q[/][assistant]a[/][user]r[/]"


def closed_at_the_end(turns, prompt):
    return "".join(f"[{r}]{t}" for r, t in turns) + ("[assistant]" if prompt else "<eos>")


def test_closing_mark_is_rewriting():
    (row,) = rendered(closed_at_the_end, [("user", "q"), ("assistant", "a")])
    assert row[5] == 1


def system_in_front(turns, prompt):
    """A beginning of its own, and turns that depend on the turn before."""
    out = "" if turns and turns[0][0] == "system" else "[default]"
    for i, (role, text) in enumerate(turns):
        out += ("=" if i and turns[i - 1][0] == role else "-") + f"{role}:{text};"
    return out + ("-assistant:" if prompt else "")


def counted(turns, prompt):
    return "".join(f"{i}:{role}:{text};" for i, (role, text) in enumerate(turns)) + (f"{len(turns)}:assistant:" if prompt else "")


def test_windows_render_what_whole_prefixes_do():
    turns = [(("user", "assistant")[t % 2], f"t{t}") for t in range(5 * chat.WINDOW)]
    rows = rendered(system_in_front, turns)
    assert "".join(r[3] for r in rows) == system_in_front(turns, False)
    (row, *_) = rendered(counted, turns)  # a number that goes back to the beginning
    assert row[5] is not None


@pytest.mark.parametrize("turns", [[("assistant", "a")], [("user", "u"), ("assistant", "")]])
def test_answers_at_the_edges(turns):
    (row,) = rendered(chat.marked_turns, turns)
    loss = [s for s in row[4] if s["loss_start"] is not None]
    assert [row[3][s["loss_start"] : s["loss_end"]] for s in loss] == [turns[-1][1]]
