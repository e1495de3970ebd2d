"""Models that answer by the hash of the record key at the end of the prompt."""

import json
from hashlib import md5

from lectern.operators.model_stage import CallableModel, ModelCallError


def digits(label: str, key: str) -> str:
    return md5(f"{label}{key}".encode()).hexdigest()


def record_key(prompt: str) -> str:
    return prompt[prompt.rindex("\nRecord: ") + len("\nRecord: "):]


def field(prompt: str, label: str) -> str:
    """The value of a one-line field."""
    start = prompt.index(f"\n{label}: ") + len(label) + 3
    return prompt[start:prompt.index("\n", start)]


class Answers:
    """Base of the stand-ins: one reply, or one exception, per prompt."""

    def reply(self, prompt: str, key: str):
        raise NotImplementedError

    def __call__(self, prompts):
        replies = []
        for prompt in prompts:
            try:
                reply = self.reply(prompt, record_key(prompt))
                replies.append(json.dumps(reply, ensure_ascii=False))
            except (ModelCallError, ValueError) as failure:
                replies.append(failure)
        return replies


class DocumentChoice(Answers):
    def reply(self, prompt, key):
        return {"is_useful": digits("", key)[0] < "c"}


class TopicExtraction(Answers):
    def reply(self, prompt, key):
        start = prompt.index("\nDocument:\n") + len("\nDocument:\n")
        lines = prompt[start:prompt.rindex("\nRecord: ")].split("\n")
        return {
            "topics": [
                {"title": line.split(".")[0], "description": line} for line in lines if line
            ]
        }


class Usefulness(Answers):
    def reply(self, prompt, key):
        return {"is_useful": digits("useful:", key)[0] < "c", "reason": "by hash"}


class ProblemType(Answers):
    def reply(self, prompt, key):
        return {"problem_type": "programming" if digits("type:", key)[0] < "8" else "qa"}


class Questions(Answers):
    """Fails with a retryable error until the attempt the key asks for."""

    def __init__(self):
        self.tried = {}

    def wanted_attempts(self, key):
        return {"0": 4, "1": 3, "2": 2}.get(digits("qa:", key)[1], 1)

    def reply(self, prompt, key):
        tried = self.tried.pop(key, 0) + 1
        if tried < self.wanted_attempts(key):
            self.tried[key] = tried
            raise ModelCallError("agent run failed")
        first = digits("n:", key)[0]
        title, description = field(prompt, "Topic title"), field(prompt, "Topic description")
        sentences = description.split(".")
        return {
            "tasks": [
                {
                    "question": f"{title} #{i}",
                    "answer": (sentences[i] if i < len(sentences) else "") or description,
                }
                for i in range(1 if first < "6" else 2 if first < "b" else 3)
            ]
        }


class FaultyQuestions(Questions):
    """Also fails for good where the hash of the key ends in ``ff``."""

    def reply(self, prompt, key):
        if digits("", key).endswith("ff"):
            raise ValueError("broken record")
        return super().reply(prompt, key)


class Reasoning(Answers):
    def reply(self, prompt, key):
        absent = digits("why:", key)[1] == "0"
        return {"reasoning": None if absent else f"Because {field(prompt, 'Answer')}"}


class Solver(Answers):
    def reply(self, prompt, key):
        if digits("solve:", key)[2] == "0":
            raise ValueError("no answer")
        question = field(prompt, "Question")
        items = [{"kind": "message", "content": f"Re: {question}"}]
        if digits("item:", key)[0] < "8":
            items.insert(0, {"kind": "reasoning", "content": f"Think {question}"})
        return {"items": items}


class AnswerJudge(Answers):
    def reply(self, prompt, key):
        return {"reason": "by hash", "is_correct": digits("solve:", key)[0] < "b"}


class RecordJudge(Answers):
    def reply(self, prompt, key):
        valid = digits("verify:", key)[0] < "c"
        return {"is_valid": valid, "feedback": "sound" if valid else "gap in the reasoning"}


def model(kind: type, max_attempts: int = 1) -> CallableModel:
    return CallableModel(load=kind, max_attempts=max_attempts)


#: By step, as the jobs take them (``--model standins.models:STEPS``).
STEPS = {
    "select_documents": model(DocumentChoice),
    "extract_topics": model(TopicExtraction),
    "judge_topics": model(Usefulness),
    "generate_qa": model(Questions, 3),
    "hindsight_reasoning": model(Reasoning, 3),
    "answer_questions": model(Solver),
    "judge_answers": model(AnswerJudge),
    "verify_records": model(RecordJudge),
}
