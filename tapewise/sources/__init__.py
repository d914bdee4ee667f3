"""Sources: loan tapes, lookup maps and the derived ``loan_tape``."""

from tapewise.sources.fixture import GOOD_STATUS, LABEL, LOAN_TAPE_SQL, labelled_tape, loan_tape, materialize_tape, read_table  # noqa: F401
from tapewise.sources.tape import (  # noqa: F401
    blank_to_null,
    drop_columns,
    inline_mapping,
    inspect_schema,
    read_mapping,
    read_tape,
    rename,
    rename_all,
    snake_case,
)
