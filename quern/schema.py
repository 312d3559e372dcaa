"""Declared schemas and fixed vocabularies of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _B = T.StringType(), T.IntegerType(), T.BooleanType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


MESSAGE = _struct(role=_S, content=_S)
SOURCE = _struct(name=_S, url=_S, license=_S, date=_S)
RECORD = _struct(id=_S, category=_S, subcategory=_S, type=_S, source=SOURCE, messages=T.ArrayType(MESSAGE), language=_S, difficulty=_I, tags=T.ArrayType(_S), quality_score=_I, verified=_B, notes=_S)
ATTRIBUTION = _struct(source_id=_S, name=_S, url=_S, license=_S, attribution_text=_S, access_date=_S, share_alike=_B)
LINEAGE = _struct(source=_S, transformations=T.ArrayType(_S), knowledge_object=_S, curated_dataset=_S, training_view=_S, future_model=_S)
ELIGIBILITY = _struct(qwen=_B, llama=_B, deepseek=_B)
KNOWLEDGE_OBJECT = _struct(
    id=_S, category=_S, subcategory=_S, difficulty=_I, knowledge_type=_S, canonical_answer=_S, metadata=T.MapType(_S, _S), source_attribution=ATTRIBUTION, license=_S, tags=T.ArrayType(_S),
    quality_score=_I, verification_status=_S, lineage=LINEAGE, training_view_eligibility=ELIGIBILITY, messages=T.ArrayType(MESSAGE), verified=_B, notes=_S,
)
#: What a normalised record may hold; record_type says which fields count.
CONTENT = _struct(question=_S, answer=_S, instruction=_S, input=_S, output=_S, title=_S, text=_S, messages=T.ArrayType(MESSAGE), raw=_S)
REVIEW = _struct(record_id=_S, category=_S, source_id=_S, reviewer=_S, review_date=_S, human_score=_I, verdict=_S, hallucination=_B, confidence=_I, notes=_S)
DECISION = _struct(record_id=_S, decision=_S, reviewer_id=_S, timestamp=_S, reason=_S)

# The controlled vocabularies.
CATEGORIES = ["01_foundation", "02_software_engineering", "03_system_engineering", "04_ai_machine_learning", "05_hardware_engineering", "06_science_engineering", "07_business_knowledge", "08_creative_knowledge", "09_personal_assistant"]
CATEGORY_SHARES = dict(zip(CATEGORIES, [0.10, 0.20, 0.15, 0.20, 0.08, 0.10, 0.07, 0.05, 0.05], strict=True))
TYPES = ["instruction", "conversation", "qa", "reasoning"]
KNOWLEDGE_TYPES = ["fact", "procedure", "concept", "reasoning", "code", "reference", "creative"]
STATUSES = ["pending", "approved", "rejected", "needs_revision", "unknown"]
ROLES = ["system", "user", "assistant", "tool"]
LIFECYCLE_STATES = ["raw", "processing", "curated", "review", "approved", "released", "archived", "rejected"]
TRANSITIONS = {
    "raw": ["processing", "rejected"],
    "processing": ["curated", "rejected", "raw"],
    "curated": ["review", "processing", "rejected"],
    "review": ["approved", "rejected", "needs_revision"],
    "needs_revision": ["review", "rejected", "curated"],
    "approved": ["released", "review"],
    "released": ["archived"],
    "archived": [],
    "rejected": ["raw"],
}
STATUS_RANK = {"approved": 4, "released": 4, "review": 3, "curated": 2, "pending": 2, "processing": 1, "raw": 0, "needs_revision": 1, "rejected": 0}
# Canonical names of licenses.
LICENSE_NAMES = {
    "mit": "MIT",
    "apache-2.0": "Apache-2.0",
    "apache 2.0": "Apache-2.0",
    "apache2": "Apache-2.0",
    "cc-by-4.0": "CC-BY-4.0",
    "cc by 4.0": "CC-BY-4.0",
    "cc-by-sa-4.0": "CC-BY-SA-4.0",
    "bsd-3-clause": "BSD-3-Clause",
    "gpl-3.0": "GPL-3.0",
    "public domain": "Public Domain",
}
# Words that mark a category, and openers of stock answers.
CATEGORY_KEYWORDS = {
    "01_foundation": ["reason", "explain", "step", "because", "therefore", "decision", "why", "principle"],
    "02_software_engineering": ["function", "code", "bug", "class", "algorithm", "refactor", "test", "variable", "api"],
    "03_system_engineering": ["linux", "docker", "kubernetes", "network", "kernel", "server", "port", "process", "config"],
    "04_ai_machine_learning": ["model", "loss", "transformer", "prompt", "rag", "token", "embedding", "training", "inference"],
    "05_hardware_engineering": ["cpu", "gpu", "firmware", "voltage", "clock", "benchmark", "pcb", "circuit", "memory"],
    "06_science_engineering": ["equation", "theorem", "integral", "force", "circuit", "matrix", "energy", "formula"],
    "07_business_knowledge": ["revenue", "strategy", "market", "profit", "roi", "stakeholder", "cost", "risk"],
    "08_creative_knowledge": ["story", "character", "metaphor", "narrative", "design", "tone", "voice", "theme"],
    "09_personal_assistant": ["schedule", "plan", "task", "prioritize", "workflow", "reminder", "goal", "habit"],
}
BOILERPLATE_OPENERS = ["sure,", "here is", "here's", "as an ai", "i'm happy to", "certainly,", "of course,"]
ACTION_VERBS = ["how", "what", "why", "write", "create", "fix", "explain", "design", "implement", "solve", "when", "should", "best"]
QUALITY_WEIGHTS = {"accuracy": 0.20, "completeness": 0.15, "technical_correctness": 0.20, "clarity": 0.15, "usefulness": 0.15, "originality": 0.05, "relevance": 0.10}
