"""Writers: message encoding, captures, prediction tables, upserts, models."""
