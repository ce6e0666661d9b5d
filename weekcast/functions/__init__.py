"""Fixed vocabularies and Column builders."""
