"""Writers for ranked lists, article texts, the chunk index and chat history."""
