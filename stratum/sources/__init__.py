"""Raw landing: text files -> typed bronze frames, parsed on executors."""
