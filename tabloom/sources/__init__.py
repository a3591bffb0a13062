from tabloom.sources.readers import read_table
from tabloom.sources.writers import write_run_record, write_scores, write_variants

__all__ = ["read_table", "write_run_record", "write_scores", "write_variants"]
