"""Every query of the subpackage, by name, with its SQL where SQL can express it."""

import corpus_pipeline  # noqa: F401
from leadlift.llm import (  # noqa: F401
    benchmark,
    caps,
    language,
    lines,
    markup,
    near,
    packing,
    paragraphs,
    personal,
    phrases,
    quality,
    resampling,
    treeweight,
)
from leadlift.llm.common import ORACLES, QUERIES  # noqa: F401
