from tickforge.functions.columns import (  # noqa: F401
    calendar_fields,
    code_u8,
    code_trunc,
    epoch_ms,
    epoch_to_ms,
    guarded_div,
    ln_pos,
    ds_from_ms,
)
