"""Training-data operators: quality rules, near-duplicates, decontamination, privacy,
mixing, language-model scores, chat formatting, licences, token counts, dataset manifests,
language identification and lexical search.

Nothing else in the library imports this subpackage."""
