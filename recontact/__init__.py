"""Campaign recontact selections on Spark: eligibility, suppression, one row per person, ledger."""
