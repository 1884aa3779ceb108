"""Deterministic responders for tests and registered queries.

Real jobs pass a model client; these stand-ins make the annotation jobs
reproducible: the reply is a pure function of the prompt, and failures
follow a fixed hash rule so retry, error routing and resume can be checked.
"""

from __future__ import annotations

import hashlib
import json


def _h(text: str) -> int:
    return int(hashlib.md5(text.encode("utf-8")).hexdigest()[:8], 16)


class TransientError(RuntimeError):
    pass


class StubPairResponder:
    """Replies with an instruction/response JSON object built from the prompt.

    * ``h % 16 == 0``: always fails (becomes an error row)
    * ``h % 16 in (1, 2)``: fails on the first call for that prompt in this
      process, then succeeds (exercises the retry)
    * ``h % 4 == 3``: reply wrapped in a code fence with a ``json`` tag
    """

    def __init__(self):
        self.seen: dict[str, int] = {}

    def __call__(self, prompts: list[str]) -> list[str]:
        out = []
        for p in prompts:
            h = _h(p)
            calls = self.seen.get(p, 0)
            self.seen[p] = calls + 1
            if h % 16 == 0:
                raise TransientError(f"permanent failure for prompt {h:08x}")
            if h % 16 in (1, 2) and calls == 0:
                raise TransientError(f"transient failure for prompt {h:08x}")
            words = p.split()
            body = json.dumps({"instruction": "Write about " + " ".join(words[:6]),
                               "response": " ".join(reversed(words[:40]))})
            out.append(f"```json\n{body}\n```" if h % 4 == 3 else body)
        return out


class StubVerdictResponder:
    """A judge stand-in: ``A``/``B`` with the reference's loose formatting
    (surrounding space, lower case), and an unparsable reply for some prompts."""

    def __call__(self, prompts: list[str]) -> list[str]:
        out = []
        for p in prompts:
            h = _h(p)
            out.append(" a\n" if h % 3 == 0 else ("B" if h % 3 == 1 else "Both are fine"))
        return out


class StubStyleResponder:
    """Contrastive-generation stand-in: the reply depends on a style prefix."""

    def __init__(self, style: str):
        self.style = style

    def __call__(self, prompts: list[str]) -> list[str]:
        out = []
        for p in prompts:
            if _h(self.style + p) % 10 == 0:
                raise TransientError("style call failed")
            words = p.split()
            out.append(f"[{self.style}] " + " ".join(words[: 5 + _h(p) % 20]))
        return out


class FlakyEchoResponder:
    """Echoes prompts upper-cased; fails a prompt's first ``fails[prompt]``
    calls in this process (``-1``: always).  For retry/error tests."""

    def __init__(self, fails: dict[str, int]):
        self.fails, self.calls = dict(fails), {}

    def __call__(self, prompts: list[str]) -> list[str]:
        out = []
        for p in prompts:
            n = self.calls.get(p, 0)
            self.calls[p] = n + 1
            f = self.fails.get(p, 0)
            if f == -1 or n < f:
                raise TransientError(f"fail {p}")
            out.append(p.upper())
        return out
