"""plazaframe: Spark analytics and table preparation for places, reviewers and their activity.

Every public function takes DataFrames (or a session) and returns DataFrames.  The package
configures no session and starts none.
"""

__version__ = "0.1.0"
