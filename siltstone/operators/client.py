"""Text models behind one HTTP service: what each surface asks, and how its reply is read.

``TextModel`` is a plain value that travels with the tasks. A surface is a function of one (``verdicts``, ``contexts``,
``paraphrases``, ``grades``, ``question_writer``) that gives the callable which the matching operator takes. Transport
and parsing errors are raised here; the operators turn them into error values of their rows.
"""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed fields of the service's requests: one JSON reply, no thinking aloud.
ONE_JSON_REPLY = {"stream": False, "format": "json", "think": False}

GATE_ROLE = "You decide which documents belong to a collection. The collection's rule: {criteria} Answer with JSON only: {{\"keep\": true or false, \"reason\": a few words}}."
CONTEXT_ROLE = 'You place excerpts in their document: for each, one short sentence on what and whom it is about. Answer with JSON only: {"contexts": [one string for each excerpt, in their order]}.'
EXPAND_ROLE = 'You put a search query in other words that mean the same. Answer with JSON only: {"queries": [strings]}.'
GRADE_ROLE = 'You judge how well passages answer a query, from 0 (not at all) to 1 (fully). Answer with JSON only: {"grades": [one number for each passage, in their order]}.'
QUESTION_ROLE = 'You write questions that people would ask and a given document answers, without naming the document. Answer with JSON only: {"questions": [strings]}.'


def post_json(url: str, body: dict, timeout: float = 120.0):
    request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json"})
    with urllib.request.urlopen(request, timeout=timeout) as r:
        return json.load(r)


@dataclass(frozen=True)
class TextModel:
    url: str
    name: str
    temperature: float = 0.0
    most_tokens: int = 1024
    timeout: float = 120.0

    def ask(self, role: str, task: str):
        """The model's reply to ``task``, parsed."""
        how = {"temperature": self.temperature, "num_predict": self.most_tokens}
        answer = post_json(f"{self.url.rstrip('/')}/api/generate", {**ONE_JSON_REPLY, "model": self.name, "system": role, "prompt": task, "options": how}, self.timeout)
        text = answer.get("response", "")
        if not text.strip():
            raise ValueError(f"model {self.name} said nothing")
        return json.loads(text)

    def ask_list(self, role: str, task: str, key: str) -> list:
        """The list under ``key`` of the reply, or the reply itself if it is a list; else none."""
        found = self.ask(role, task)
        found = found.get(key) if isinstance(found, dict) else found
        return found if isinstance(found, list) else []

    def vectors(self, texts: list[str]) -> list[list[float]]:
        return post_json(f"{self.url.rstrip('/')}/api/embed", {"model": self.name, "input": texts}, self.timeout)["embeddings"]


def listing(label: str, texts: list[str], most: int | None = None) -> str:
    return "\n\n".join(f"{label} {i}: {(t or '')[:most]}" for i, t in enumerate(texts, 1))


def verdicts(model: TextModel, criteria: str) -> Callable[[Column, Column], Column]:
    """Gate: the reply on title and text as a JSON string; a failed call is the object {"failed": why}, which has no verdict."""
    role = GATE_ROLE.format(criteria=criteria)

    @F.pandas_udf("string")
    def run(titles: pd.Series, texts: pd.Series) -> pd.Series:
        def one(title, text) -> str:
            try:
                return json.dumps(model.ask(role, f"Title: {title or ''}\n\nText:\n{text or ''}"))
            except Exception as e:
                return json.dumps({"failed": f"{type(e).__name__}: {e}"})

        return pd.Series([one(*x) for x in zip(titles, texts, strict=True)], dtype=object)

    return lambda title, text: run(title.cast("string"), text)


def contexts(model: TextModel) -> Callable[[str, list[str]], list[str]]:
    return lambda doc, chunks: model.ask_list(CONTEXT_ROLE, f"Document:\n{doc}\n\n{listing('Excerpt', chunks)}\n\nContexts wanted: {len(chunks)}", "contexts")


def paraphrases(model: TextModel) -> Callable[[str, int], list[str]]:
    return lambda query, n: model.ask_list(EXPAND_ROLE, f"Query: {query}\nOther wordings wanted: {n}", "queries")


def grades(model: TextModel, most: int = 600) -> Callable[[str, list[str]], list]:
    return lambda query, texts: model.ask_list(GRADE_ROLE, f"Query: {query}\n\n{listing('Passage', texts, most)}\n\nGrades wanted: {len(texts)}", "grades")


def question_writer(model: TextModel) -> Callable[[str, int], list[str]]:
    warm = replace(model, temperature=0.2)
    return lambda text, n: warm.ask_list(QUESTION_ROLE, f"Document:\n{text}\n\nQuestions wanted: {n}", "questions")
