"""Where templates of unknown logs come from.

A source is asked once for each group of like messages, never for a log. The default is deterministic and offline: what the messages
have in common, place by place. A model behind any transport is the same interface with prompts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from lograil.functions import imperative as I
from lograil.functions import text as T

WILD = T.WILD
#: What a source counts.
USAGE = ("llm_invocations", "prompt_tokens", "completion_tokens", "failed_invocations")


class TemplateSource:
    """template: of some messages; same_event and unify: of two templates."""

    def recorded(self) -> list[dict]:
        """Questions and answers since the last call, if the source keeps a record."""
        return []

    def template(self, messages: list[str]) -> str:
        raise NotImplementedError

    def same_event(self, a: str, b: str) -> bool:
        raise NotImplementedError

    def unify(self, a: str, b: str) -> str:
        x, y = a.split(" "), b.split(" ")
        return " ".join(p if p == q else WILD for p, q in zip(x, y, strict=True)) if len(x) == len(y) else a


def mask(message: str) -> str:
    """Obvious variables as wildcards, for one message."""
    import re

    for p in T.VARIABLE_PATTERNS:
        message = re.sub(p, WILD, message)
    return re.sub(r"<\*>\s*(?:<\*>\s*)+", "<*> ", message).strip()


class Deterministic(TemplateSource):
    """Tokens that all messages of the first one's length share, masked ones as wildcards."""

    def template(self, messages: list[str]) -> str:
        split = [mask(m).split(" ") for m in messages]
        same = [s for s in split if len(s) == len(split[0])]
        return " ".join(t[0] if len(set(t)) == 1 else WILD for t in zip(*same, strict=True))

    def same_event(self, a: str, b: str) -> bool:
        return self.template([a, b]) != WILD and len(a.split(" ")) == len(b.split(" "))


@dataclass
class Fixed(TemplateSource):
    """One answer for everything, for tests."""

    answer: str = "User <*> logged in"

    def template(self, messages: list[str]) -> str:
        return self.answer

    def same_event(self, a: str, b: str) -> bool:
        return True


@dataclass
class Asked(TemplateSource):
    """A model. ask: chat messages -> (answer, prompt tokens, completion tokens); it may fail, and is then asked once more.

    `usage` grows wherever the source runs; plans bring what it counted back as columns, and with `record` the questions and answers too.
    `examples` (messages -> (message, template) pairs) and `prompt` decide what the model is shown.
    """

    ask: Callable[[list[dict]], tuple[str, int, int]]
    prompt: Callable[[list[str]], list[dict]]
    usage: dict = field(default_factory=lambda: dict.fromkeys(USAGE, 0))
    record: bool = False
    _calls: list[dict] = field(default_factory=list)

    def recorded(self) -> list[dict]:
        calls, self._calls = self._calls, []
        return calls

    def _answer(self, messages: list[dict]) -> str:
        for last in (False, True):
            try:
                text, p, c = self.ask(messages)
            except Exception as e:
                if self.record:
                    self._calls.append({"request": messages, "error": str(e)})
                if last:
                    self.usage["failed_invocations"] += 1
                    raise
                continue
            for k, v in (("llm_invocations", 1), ("prompt_tokens", p), ("completion_tokens", c)):
                self.usage[k] += v
            if self.record:
                self._calls.append({"request": messages, "response": text, "prompt_tokens": p, "completion_tokens": c})
            return text
        raise AssertionError

    def template(self, messages: list[str]) -> str:
        return I.template_of_answer(self._answer(self.prompt(messages)), messages[0])

    def same_event(self, a: str, b: str) -> bool:
        question = f"Do these two log templates describe the same kind of event? Answer yes or no.\nA: {a}\nB: {b}"
        return self._answer([{"role": "user", "content": question}]).strip().lower().startswith("yes")

    def unify(self, a: str, b: str) -> str:
        question = f"Write one log template that covers both, with {WILD} for what differs.\nA: {a}\nB: {b}"
        return I.plain_answer(self._answer([{"role": "user", "content": question}]))


class Memoised:
    """An embedding function that asks its model once for each text."""

    def __init__(self, embed: Callable[[str], list[float]]):
        self.embed, self.known = embed, {}

    def __call__(self, text: str):
        if text not in self.known:
            self.known[text] = self.embed(text)
        return self.known[text]


def shots(pool: list[tuple[str, str]], message: str, count: int = 3, strategy: str = "similarity") -> list[tuple[str, str]]:
    """Examples (message, template) of a pool for a question: those most like the message, or a choice unlike each other."""
    from lograil.operators.sample import diverse_examples, jaccard_matrix

    if strategy not in ("similarity", "diversity"):
        raise ValueError(f"no such choice of examples: {strategy}")
    if strategy == "diversity":
        return [pool[i] for i in diverse_examples([m for m, _ in pool], count)]
    far = jaccard_matrix([message, *(m for m, _ in pool)])[0, 1:]
    return [pool[i] for i in far.argsort(kind="stable")[:count]]


def categories_prompt(message: str, shots: list[tuple[str, str]], categories: str = "ecs_3", plain: bool = False) -> list[dict]:
    """A question about one message with tagged variables; shots: (message, template). plain: a template alone is wanted, not JSON."""
    tags = ", ".join(T.CATEGORIES[categories])
    form = "the template alone" if plain else 'JSON with the keys "template" and "variables" (category, value)'
    shown = "".join(f"\nLog: {m}\nTemplate: {t}" for m, t in shots)
    short = message if len(message) <= 3000 else message[:3000] + "..."
    system = f"Replace what varies in a log message by one of these tags: {tags}. Answer with {form}, and nothing else." + (f"\nExamples:{shown}" if shown else "")
    return [{"role": "system", "content": system}, {"role": "user", "content": f"Log: {short}\n" + ("Parsed Log:" if plain else "Output:")}]


def batch_prompt(messages: list[str], variables: list[str] = ()) -> list[dict]:
    """A question about several messages of one event; variables: values that varied before."""
    known = f" Values that varied before: {', '.join(variables)}." if variables else ""
    system = f"The log messages are of one kind. Write their common template between backticks, with {WILD} for what varies.{known}"
    return [{"role": "system", "content": system}, {"role": "user", "content": "\n".join(messages)}]


def group_prompt(messages: list[str]) -> list[dict]:
    """A question about a sample of a group, commas taken out of the messages."""
    listed = str([m.replace(",", "") for m in messages])
    system = f"Write one template for all log messages of the list, between backticks, with {WILD} for what varies."
    return [{"role": "system", "content": system}, {"role": "user", "content": f"Log list: {listed}"}]
