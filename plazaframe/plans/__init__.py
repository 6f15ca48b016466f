"""Questions, preparation plans and the queries over the sample tables."""
