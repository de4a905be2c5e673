"""Named query plans, their reference SQL, and the batch load."""
